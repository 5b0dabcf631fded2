import duckdb
import pytest

from stationflow.llm.queries import ORACLES

TABLES = "documents pages benchmark labels conversations".split()

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that operators must stand: null, empty, blank, without letters, one long word, very many lines, other scripts.
ODD = [None, "", " \n\t\r ", "!!! 123 ...", "x" * 70_000, "line of text.\n" * 3_000, "Ünï cödé 日本語 текст \U0001f600", "\x00\x0b\x1c", "\n", "a"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, each under two ids and one of the rows twice, rows without id, and columns named as operators' own."""
    rows = [(i, t, "en" if i % 3 else None, None, None) for i, t in enumerate(ODD)]
    rows += [(100 + i, t, "fr", "s", 1) for i, t in enumerate(ODD)] + [rows[5], rows[6], (None, "no id here", None, None, None), (None, None, "en", None, 0)]
    extra = "name long, kept boolean, score double, start int, hits string, n_lines string, lang_pred int, node long, `_id` long, rep long"
    return spark.createDataFrame([(*r, 1, False, 0.5, 2, "h", "n", 3, 4, 5, 6) for r in rows], f"{DOCS}, {extra}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def oracle(sf_dir):
    """Rows of a query's SQL, as sorted tuples by column name."""
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")

    def rows(name):
        found = con.execute(ORACLES[name])
        names = [c[0] for c in found.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        return sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=repr)

    return rows


def by_name(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)
