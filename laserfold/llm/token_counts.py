"""Token counts with a whole-token shortcut.

`whole_words` proves, once and before the job, which vocabulary strings the library
encodes alone as a single token. A pre-token in that table counts one without being
merged; only the rest is merged. The table is bounded by the vocabulary and travels as
a broadcast. The counting is one pass over the texts: no shuffle.

Results: a null or empty text has no bytes and no tokens and is within every limit; a
count equal to the limit is not over it; very long texts are counted whole; repeated rows
give repeated results; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laserfold.llm import tokens
from laserfold.llm.common import Batches, column, slices, text_of

LIMIT = 2048
SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


def whole_words(path: str) -> frozenset[str]:
    """Vocabulary strings that, encoded alone, come out as exactly their own token."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    back = {c: b for b, c in tokens.byte_letters().items()}
    found = {}
    for entry, number in tokenizer.get_vocab(with_added_tokens=False).items():
        spelled = entry.removesuffix("</w>")
        try:
            word = bytes(back[c] for c in spelled).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        # A plain word is one pre-token for the shortcut; others never ask for it.
        if word and not any(c.isspace() for c in word):
            found[word] = number if entry.endswith("</w>") else found.get(word, number)
    words = list(found)
    encoded = tokenizer.encode_batch(words, add_special_tokens=False)
    return frozenset(w for w, e in zip(words, encoded, strict=True) if e.ids == [found[w]])


_json_counters: dict[str, tokens.Encoder] = {}


def _json_counter(path: str, whole: frozenset[str]) -> tokens.Encoder:
    if path not in _json_counters:
        _json_counters[path] = tokens.Encoder(path, whole)
    return _json_counters[path]


@functools.lru_cache(maxsize=4)
def _model_counter(path: str) -> Callable[[list[str]], list[int]]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda batch: [len(x) for x in model.encode(batch, num_threads=1)] if batch else []


def count_tokens(
    docs: DataFrame, path: str, *, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs`."""
    whole = None if path.endswith(".model") else whole_words(path)
    shared = docs.sparkSession.sparkContext.broadcast(whole)

    def run(batches: Batches) -> Batches:
        if shared.value is None:
            count = _model_counter(path)
        else:
            count = _json_counter(path, shared.value).counts
        for batch in slices(batches):
            found = batch.column("text").to_pylist()
            n = pa.array(count(found), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_bytes"),
                    n,
                    pc.greater(n, pa.scalar(limit, pa.int64())),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(
        column(docs, "doc_id", "bigint").alias("doc_id"),
        text_of(docs, text).alias("text"),
        F.octet_length(text_of(docs, text)).cast("bigint").alias("n_bytes"),
    )
    return rows.mapInArrow(run, SCHEMA)
