import pytest

VOCABULARY = "byte_bpe_50k.json"

#: What a documents table may hold besides ordinary rows.
ODD = [(1, None), (2, ""), (3, " \t\n\r\x0b\x0c "), (4, "word"), (4, "word"), (None, "word word word word word word"), (5, "a" * 30_000), (6, "é " * 9_000), (7, "1234 5678 !!"), (8, "  two  spaces\n\nand <|endoftext|> more ")]


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    from tablebridge.llm.token_counts import read_vocabulary

    return read_vocabulary(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="session")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, "y", "src", "en") for i, t in ODD], "doc_id long, text string, id string, score int, kept string, source string, lang string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
