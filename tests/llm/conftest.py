import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, rank string, key string"


@pytest.fixture
def documents(spark):
    """A frame of documents from (id, text[, lang[, source]]) with extra columns of clashing names."""
    def make(rows):
        full = [(*r, *(None,) * (4 - len(r)))[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None, 7, "r", "k") for r in full], DOCS)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def words(seed: int, n: int, vocabulary: int = 4000) -> list[str]:
    import random

    r = random.Random(seed)
    letters = "bcdfghklmnprstvwz"
    return ["a" + letters[x % 17] + "e" + letters[x // 17 % 17] + "o" + letters[x // 289] for x in (r.randrange(vocabulary) for _ in range(n))]


@pytest.fixture(scope="session")
def prose():
    return lambda seed, n=120: " ".join(words(seed, n))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="session")
def collect():
    return rows
