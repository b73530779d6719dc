import json
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    from stratalake.session import build_session

    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    from stratalake.session import work_dir

    return work_dir(spark, "test")


@pytest.fixture
def write_bronze(folder):
    """Write envelopes into a bronze folder; one file per call."""
    made = []

    def write(envelopes, name=None, lines=True):
        os.makedirs(f"{folder}/in", exist_ok=True)
        made.append(name or f"part-{len(made)}.json")
        with open(f"{folder}/in/{made[-1]}", "w") as out:
            if isinstance(envelopes, str):
                out.write(envelopes)
            elif lines:
                out.write("\n".join(json.dumps(e) for e in envelopes))
            else:
                json.dump(envelopes, out, indent=1)
        return f"{folder}/in"

    return write


def envelope(search, recordings, at="2024-01-01T00:00:00+00:00", **rest):
    return {"artist_search": search, "extracted_at": at, "data": {"recordings": recordings}, **rest}


def rows(df):
    """The frame's rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duckdb_over(folder, parts=False):
    """The tables as views; with `parts` each table is a folder that Spark wrote."""
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        files = f"{folder}/{name}.parquet" + ("/*.parquet" if parts else "")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con
