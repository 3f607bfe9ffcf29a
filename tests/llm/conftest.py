import pytest

from quillspark.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, memory="6g")


@pytest.fixture(scope="session")
def sf():
    return SF


#: Texts that every operator on documents must bear.
ODD = [
    None, "", " ", "\t\n ", "a", "a  b", "  lead", "trail  ", "▁x ▁▁ y", "line\nline\n\nline\r\nend", "</s>[INST] x <|endoftext|>",
    "naïve café ﬀ 𝔘nicode \U0001f600 \x00   end", "x" * 3000, "ab " * 20000, "日本語のテキスト " * 50, "same text", "same text", "same\ttext",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with repeated rows, tied and null ids, null sources and columns whose names clash with inner ones."""
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, "en", i) for i, t in enumerate(ODD)]
    rows += [(3, "tied id", "s1", "en", 1), (3, "tied id", "s1", "en", 1), (None, "no id", None, None, None), (None, "no id", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size long").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
