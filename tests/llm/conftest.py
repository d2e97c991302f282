import pytest

# names that operators use inside, as further columns of their input
CLASHING = (
    "score double, features string, digest string, rep long, component_id long, kept boolean, "
    "size string, taken long, label int, shard int, hilbert long, pii_base string, pii_spans "
    "string, keys string, ids string, _key long, _n long, count long, key string, n_words long"
)
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with clashing columns."""

    def build(rows, partitions=3):
        wide = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows
        ]
        df = spark.createDataFrame(wide, DOCUMENT).repartition(partitions)
        for field in CLASHING.split(", "):
            name, kind = field.split(" ")
            df = df.selectExpr("*", f"cast(7 as {kind}) AS {name}")
        return df

    return build
