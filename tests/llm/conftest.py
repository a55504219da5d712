import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A small table with the awkward rows: nulls, empty and long texts, copies, repeated
    rows, a null number, and columns named like the results."""
    long = " ".join(f"word{i % 997} filler{i % 31}" for i in range(30_000))
    base = " ".join(f"t{i}" for i in range(60))
    near = base.replace("t30 ", "x30 ")
    rows = [
        (1, "Hello World"),
        (2, "hello world"),
        (3, None),
        (4, ""),
        (5, long),
        (6, base),
        (7, near),
        (8, "one two three"),
        (9, "ONE two  three"),
        (10, "   \n\t "),
        (11, "mail a.b@c-d.example and +1 (555) 010-9999 ip 10.0.0.255 card 4111 1111 1111 1111"),
        (11, "mail a.b@c-d.example and +1 (555) 010-9999 ip 10.0.0.255 card 4111 1111 1111 1111"),
        (None, "no number"),
        (12, "é中文😀 　 mixed spaces  double"),
    ]
    data = [(i, t, "en", "src0", None if t is None else len(t), False, 7, "x", 0.5) for i, t in rows]
    return spark.createDataFrame(
        data,
        "doc_id long, text string, lang string, source string, n_chars long, kept boolean, component_id long, spans string, score double",
    )


@pytest.fixture(scope="session")
def nothing(docs):
    return docs.where("false")
