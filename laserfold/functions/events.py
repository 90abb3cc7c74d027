"""Text and payload expressions for job events."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from laserfold.params import JOB_STATES

# Payload names, compared without case.
RUN_ID_NAMES = ("run_id", "runid")
JOB_ID_NAMES = ("job_id", "jobid")
STATUS_NAMES = ("result_state", "resultstate", "status")
ERROR_NAMES = (
    "error_message", "errormessage", "message", "error", "state_message", "statemessage",
)
# Status words.
SUCCESS_WORDS = ("SUCCEEDED", "OK", "COMPLETED")
SUCCESS_PART = "SUCCESS"
FAILURE_PARTS = ("FAIL", "ERROR", "CANCEL")


def normalize_status(status: str | Column) -> Column:
    """SUCCESS, FAILED, or null where the text says neither."""
    text = F.upper(F.trim(status))
    good = text.contains(SUCCESS_PART) | text.isin(*SUCCESS_WORDS)
    bad = text.rlike("|".join(FAILURE_PARTS))
    return F.when(good, "SUCCESS").when(bad, "FAILED")


def text_or_null(text: str | Column) -> Column:
    """Null for blank text, else the whole text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(F.trim(column)) > 0, column)


def clip_text(text: str | Column, limit: int) -> Column:
    """Null for blank text, else its first `limit` characters."""
    return F.substring(text_or_null(text), 1, limit)


def state_rank(status: str | Column) -> Column:
    """Position in the job life cycle, from 1; both end states share the last rank."""
    column = F.col(status) if isinstance(status, str) else status
    last = len(JOB_STATES) - 1
    ranks = {name: min(i + 1, last) for i, name in enumerate(JOB_STATES)}
    pairs = [F.lit(v) for item in ranks.items() for v in item]
    return F.create_map(*pairs)[column]


def payload_fields(payload: str | Column) -> Column:
    """Struct of runId, jobId, status and error text found in a JSON payload.

    For each field the first property bearing one of its names counts, nearest to
    the root first, at any depth. Texts that are not JSON give nulls."""
    wanted = {
        "runId": RUN_ID_NAMES,
        "jobId": JOB_ID_NAMES,
        "status": STATUS_NAMES,
        "error": ERROR_NAMES,
    }

    def search(texts: pd.Series) -> pd.DataFrame:
        import json

        import pandas

        fields_of = {name: field for field, names in wanted.items() for name in names}

        def found(text):
            hits = {}
            try:
                level = [json.loads(text)]
            except (TypeError, ValueError):
                return hits
            while level and len(hits) < len(wanted):
                deeper = []
                for node in level:
                    items = node.items() if isinstance(node, dict) else (
                        ((None, v) for v in node) if isinstance(node, list) else ()
                    )
                    for name, value in items:
                        field = fields_of.get(name.lower()) if name else None
                        if field and field not in hits:
                            hits[field] = value
                        if isinstance(value, (dict, list)):
                            deeper.append(value)
                level = deeper
            return {
                k: v if v is None or isinstance(v, str) else json.dumps(v) for k, v in hits.items()
            }

        return pandas.DataFrame([found(t) for t in texts], columns=list(wanted), dtype="object")

    schema = StructType([StructField(name, StringType()) for name in wanted])
    return F.pandas_udf(search, schema)(payload)
