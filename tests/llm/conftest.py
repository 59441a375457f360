import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from isobar.llm.store import ship

    ship(spark)
