import pyarrow as pa
import pyarrow.parquet as pq
import pytest

#: Texts that every operator must take: null, empty, blank, odd white space, controls, non-ASCII, repeats, very long.
ODD = [None, "", " ", "a", "\n\n", "  two  spaces ", "tab\tand\r\nline", "naïve Ünïcödé — 漢字 🙂", "x\x00y\x1cz", "the same words again and again", "the same words again and again", "word " * 30_000, "z" * 120_000]


@pytest.fixture()
def odd_docs(spark):
    """Documents with odd texts, a repeated row, a repeated doc_id, and columns whose names may clash."""
    rows = [(i, t, None if i % 3 else "en", "src", 0, "x") for i, t in enumerate(ODD)]
    rows += [rows[9], (9, "another text of the same id", "en", None, 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string")


@pytest.fixture()
def as_tables(tmp_path):
    """Write {table: (rows, schema)} as the driver's folder of Parquet files."""

    def write(**tables):
        for name, (columns, schema) in tables.items():
            pq.write_table(pa.table(columns, schema=schema), tmp_path / f"{name}.parquet")
        return str(tmp_path)

    return write
