import signal

import pytest

from tallyforge.session import local_session

#: seconds after which a test fails, so that one that never ends does not hold the others
LONGEST = 600


@pytest.hookimpl(wrapper=True)
def pytest_runtest_call(item):
    def over(*_):
        raise TimeoutError(f"longer than {LONGEST} seconds")

    before = signal.signal(signal.SIGALRM, over)
    signal.alarm(LONGEST)
    try:
        return (yield)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests")
    yield session
    session.stop()
