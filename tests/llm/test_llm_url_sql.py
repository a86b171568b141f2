"""The URL filter's SQL and query where registered domains lie below suffixes of two labels."""

import random
from types import SimpleNamespace

import pyarrow as pa
import pyarrow.parquet as pq

import oracle
from personpub.llm.url_filter import SQL, op2_url_filter


def test_same_rows_below_long_suffixes_and_addresses(spark, tmp_path):
    rng = random.Random(6)
    hosts = ["x.bad.co.uk", "y.bad.co.uk", "fine.co.uk", "co.uk", "uk", "a.b.com.au", "b.com.au", "10.0.0.1", "10.0.1.1",
             "10.0.0.1:80", "[::1]", "1.2.3.4.5", "x.example.org", "example.org", "t.net", "www.example.com", "UP.Bad.Co.Uk"]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/en/x', '/es/?q=1', '/fr/#a'])}" for _ in range(400)]
    urls += [None, "", "nothing", "http://", "://"]
    ids = list(range(len(urls)))
    pages = pa.table({"page_id": ids, "url": pa.array(urls, pa.string()), "html": [""] * len(urls)})
    bad = [0 if u and "bad" in u.lower() and rng.random() < 0.9 else int(rng.random() < 0.9) for u in urls]
    labels = pa.table({"doc_id": ids[::2], "quality": pa.array(bad[::2], pa.int32()), "toxic": pa.array([0] * len(ids[::2]), pa.int32())})
    for name in oracle.TABLES:
        table = {"pages": pages, "labels": labels}.get(name, pa.table({"doc_id": [1]}))
        pq.write_table(table, f"{tmp_path}/{name}.parquet")
    case = SimpleNamespace(query=op2_url_filter, sql=SQL)
    assert oracle.differences(spark, oracle.connect(str(tmp_path)), case, str(tmp_path)) == []
