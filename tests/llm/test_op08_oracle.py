import duckdb
import pytest
from test_op08_arc_warc import PAGES, brute

from fieldloom.llm import queries as Q


def rows(con):
    rel = con.execute(Q.ORACLE["op8_arc_warc"])
    assert [d[0] for d in rel.description] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted(rel.fetchall(), key=repr)


def test_oracle_on_awkward_pages():
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    assert rows(con) == brute(PAGES)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_matches_oracle(spark, sf):
    sf = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    assert sorted((tuple(r) for r in Q.op8_arc_warc(spark, sf).collect()), key=repr) == rows(con)
