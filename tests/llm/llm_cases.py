"""Rows every operator must bear: nulls, empty and long texts, repeated rows, odd extra columns."""

from __future__ import annotations

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key int, score string, "
    "spans string, tokens int, row string, `a.b` int"
)
LONG = "lorem ipsum dolor sit amet consectetur " * 6_000


def odd_rows() -> list[tuple]:
    texts = [
        (1, "The quick brown fox jumps over the lazy dog near the old river bank.", "en", "s1"),
        (2, "", "en", "s1"),
        (3, None, None, None),
        (4, LONG, "en", "s2"),
        (5, "Der schnelle braune Fuchs springt über den faulen Hund am alten Fluss.", "de", "s2"),
        (5, "Der schnelle braune Fuchs springt über den faulen Hund am alten Fluss.", "de", "s2"),
        (5, "Another text under the same number, quite unlike the first one of them.", "en", None),
        (None, "A text that has no number but many words in it all the same, you see.", "en", "s1"),
        (None, None, None, "s3"),
        (7, " \t\n ", "en", "s1"),
        (8, "12345 67890 !!! \U0001f600", None, "s1"),
        (9, "日本語のテキスト と 漢字", "ja", "s1"),
    ]
    return [(i, t, la, s, None if t is None else len(t), "x", 1, "y", "z", 2, "r", 3) for i, t, la, s in texts]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def docs_of(spark, texts, start=0):
    return spark.createDataFrame([(i + start, t) for i, t in enumerate(texts)], "doc_id bigint, text string")


def documents(folder: str):
    import duckdb

    con = duckdb.connect()
    return con.execute(f"select doc_id, text, lang from read_parquet('{folder}/documents.parquet') order by doc_id").fetchall()
