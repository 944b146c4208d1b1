import pytest

CLASHING = ["rid", "leader", "body", "kept", "id", "text_sha256", "cid", "h", "word", "run", "bucket", "pack_group"]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from relq.llm.shipping import ship

    ship(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty, short, very long and repeated texts, shared ids, a null id,
    and columns whose names the operators use themselves."""
    words = " ".join(f"w{i}" for i in range(30000))  # about 200 kB
    passage = " ".join(f"shared{i}" for i in range(90))
    texts = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
        (2, None), (3, ""), (4, "   \t\n "), (5, "The quick  brown\tfox jumps over the lazy dog near the river bank today."),
        (6, words), (7, words), (8, words + " end"), (9, "one two"), (10, "one two"), (11, "x"),
        (12, "a start here " + passage + " and an end"), (13, "another beginning " + passage + " tail"), (14, passage),
        (15, "aaaa " * 300), (16, "Released under the MIT License.\nAnd cc-by too"), (None, "a text without an id"),
        (17, "repeated row"), (17, "repeated row"), (18, "same id, one"), (18, "same id, two"), (19, "été naïve ὈΔΥΣΣΕΎΣ 数字 12 \u0301x"),
    ]
    rows = [(i, t, None if i == 9 else "en", "s", *[str(k) for k, _ in enumerate(CLASHING)]) for i, t in texts]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
