import pytest

SCHEMA = "doc_id long, text string, lang string, digest string, component_id string, label string, key string, n int, score string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with extra columns whose names operators use themselves."""
    return lambda rows: spark.createDataFrame([(i, t, "en", "d", "c", "l", "k", 0, "s") for i, t in rows], SCHEMA).repartition(3)


PROSE = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strong potions for the old king"


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and blank texts, repeated rows and ids, ties, a very long text, no word breaks, other scripts."""
    return [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE.upper()), (4, None), (5, ""), (6, " \t\n"), (None, PROSE), (None, None), (7, "one"), (7, "one two"),
        (8, PROSE * 400), (9, "x" * 30000), (10, "日本語 テキスト é ß   end"), (11, "a\x00b"), (12, PROSE.replace("fox", "cat")),
    ]
