import pytest

EXTRA = "id string, key string, host string, line string, hash string, th string, toxic string, score string, items string, cls string, value string, n_lines string, __host string, __drops string, __lines string, __kept string, __id string, __found string, __w string, __s string, __items string, __of string, __salt string, __part string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, lang[, source]]), with extra columns whose names are used inside."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1]), *["x"] * len(EXTRA.split(", "))) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make
