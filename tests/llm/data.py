"""Small awkward tables that every operator has to take."""

import duckdb

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n \n",
    "a",
    "one two three four",
    "one two three four",
    "x  y\t\tz \n  w",
    "don't  STOP, 12 34. Ünïcödé ß 日本語 👍🏽",
    "a<|endoftext|>b <|startoftext|> <|END",
    "nul \x00 byte",
    "no\u00a0break\u2003space \u00a0 end ",
    "aaaaaaaaaaaa" * 20,
    LONG,
    LONG,
]


def odd_docs(spark):
    """Null ids, repeated rows, clashing names and a column more than documents has."""
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "some text", None, None, None, None), (6, ODD_TEXTS[6], "en", "s", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string")


def no_docs(spark):
    return odd_docs(spark).filter("doc_id < 0")


def texts_of(folder=SF_DIR):
    return duckdb.sql(f"select doc_id, text from '{folder}/documents.parquet' order by doc_id").fetchall()
