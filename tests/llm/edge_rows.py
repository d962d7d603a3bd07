"""Small documents with everything that can go wrong in a column."""

from __future__ import annotations

# Names that operators use inside, as extra columns of the input.
CLASHING = (
    "size row_key row_id node root features first target words finish bucket line class signature "
    "held_out score predicted lang_pred seed kind file block start pass taken link"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(40_000))
SAME = "The very same text stands here twice, with more than five words."
TEXTS = [
    (1, "", "en", "a"),
    (2, None, None, None),
    (3, LONG, "en", "a"),
    (4, SAME, "en", "b"),
    (4, SAME, "en", "b"),
    (5, SAME, "de", "c"),
    (None, "A text without an id, and with words enough for shingles.", "en", None),
    (6, " \n\t ", None, "b"),
    (7, "12 34 .. !!", "en", "a"),
    (8, "one", "fr", "c"),
]


def edge_documents(spark):
    rows = [(i, t, lang, s, None if t is None else len(t), *["x"] * len(CLASHING))
            for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
