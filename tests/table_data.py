"""What the tests of the tables share. (A helper module, because `conftest` names another file in each test folder.)"""

DATA = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())
