"""Small hand-made tables with the awkward cases that operators must handle."""

import functools
import random

from laserfold.llm import tokens

PATH = tokens.default_path()
DOC_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that are called like results or helpers of the operators.
CLASHES = "score string, kept string, key string, ids string, start string, epoch string, part int"


def prose(n, seed):
    draw = random.Random(seed)
    stems = ["and", "the", "of", "tion", "er", "wald", "été", "niño", "straße", "don't", "x"]
    words = ["".join(draw.choice(stems) for _ in range(draw.randint(1, 3))) for _ in range(n)]
    return " ".join(words)


def awkward():
    """Rows of documents: nulls, empty, one very long text, equal rows, odd characters."""
    long = prose(30_000, 1)
    near = prose(200, 2).split()
    changed = near[:100] + ["changed"] + near[101:]
    rows = [
        (1, prose(120, 3), "en", "a"),
        (2, prose(120, 3), "en", "b"),
        (2, prose(120, 3), "en", "b"),
        (3, None, "en", "a"),
        (4, "", None, "a"),
        (5, " \n\t ", "de", None),
        (None, prose(80, 4), "de", "c"),
        (None, None, None, None),
        (6, long, "en", "hot"),
        (7, " ".join(near), "en", "hot"),
        (8, " ".join(changed), "en", "hot"),
        (9, "two words", "en", "c"),
        (10, "ZWEI\x1cx　<|endoftext|> 中文 ́e é 123 ½ Σίσυφος İ", "xx", "c"),
        (11, "THE!! THE!! " * 60, "en", "c"),
        (-5, "a\na\n\na\nb " * 30, "fr", ""),
    ]
    return [(*r, len(r[1]) if r[1] else None) for r in rows]


def documents(spark, rows=None, clashing=True):
    rows = awkward() if rows is None else rows
    if not clashing:
        return spark.createDataFrame(rows, DOC_DDL)
    return spark.createDataFrame(
        [(*r, "s", "k", "y", "i", "0", "e", 7) for r in rows], f"{DOC_DDL}, {CLASHES}"
    )


@functools.cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@functools.cache
def library_ids(text):
    return library().encode(text or "", add_special_tokens=False).ids
