import pytest

from duebook.session import open_local


@pytest.fixture(scope="session")
def spark():
    session = open_local(4, spark__driver__memory="6g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from duebook.session import scratch_folder

    return scratch_folder(spark, "test")
