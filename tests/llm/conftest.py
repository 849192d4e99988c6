import os

import pytest


@pytest.fixture(scope="session")
def llm_spark(spark):
    """The session; its shared folder is the one that the setting names, or one of its own where it is unset."""
    return spark


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path
