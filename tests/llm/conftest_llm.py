import pytest

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho "
SCHEMA = "doc_id long, text string, lang string, source string, size string, shard string, score string, k1 int, begin int"


def messy_rows():
    """Nulls, empty and long texts, ties, copies, near copies, and names that clash."""
    rows = [
        (1, LONG * 3 + "write to a.b@c.example.com now", "en", "s1"),
        (2, LONG * 3 + "write to a.b@c.example.com now", "en", "s1"),
        (2, LONG * 3 + "write to a.b@c.example.com now", "en", "s1"),
        (3, None, "en", "s2"),
        (4, "", "en", None),
        (5, "   \n\t", None, "s2"),
        (None, "no id here, call +1 (614) 555-8001 or 10.0.0.256", "en", "s2"),
        (None, None, None, None),
        (6, LONG * 400 + "tail 192.168.0.1 of a long text", "de", "s3"),
        (7, "One line\nSame Line \n\n  same line\nx", "fr", "s1"),
        (-8, "Ünï çödé — " + LONG + " 4111 1111 1111 1111 😀 mail x@y.z", "es", "s3"),
        (9, LONG, "en", ""),
    ]
    rows += [(100 + i, f"same line\nOther {i}\n" + LONG + f"{i}", "en", "s1") for i in range(10)]
    return [(*r, "a", "b", "c", i, -i) for i, r in enumerate(rows)]


@pytest.fixture(scope="session")
def messy(spark):
    rows = messy_rows()
    return spark.createDataFrame(rows, SCHEMA).repartition(3), [(r[0], r[1]) for r in rows], rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf(tmp_path_factory):
    return "/root/testdata/sf0.001"


def sort(rows):
    return sorted((tuple(r) for r in rows), key=repr)
