import random

import pytest
from text_cases import sentence


@pytest.fixture(scope="session")
def tokenizer_file():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def draw():
    return random.Random(7)


@pytest.fixture
def prose(draw):
    return lambda n: sentence(draw, n)
