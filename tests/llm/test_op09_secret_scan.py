import hashlib
import re

import pytest
from helpers import docs_frame, sample_docs

from fieldloom.llm import queries as Q
from fieldloom.llm.secret_scan import KINDS, SCOPE, redact, scan

RX = {
    "assign": re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"(AKIA[A-Z0-9]+)"),
    "hex": re.compile(r"([0-9a-f]+)"),
    "account": re.compile(r"""(?ai:client_?id|access_?key_?id|user_?name|account|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})"""),
    "mixed": re.compile(r"((?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2})"),
    "endpoint": re.compile(r"(?ai:https?|jdbc:[a-z]+|redis|amqp|mongodb|postgres|mysql)(://[A-Za-z0-9._@:-]+)"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24, "account": 3, "mixed": 32, "endpoint": 4}
ROLE = {"assign": "secret", "hex": "secret", "mixed": "secret", "access": "id", "account": "id", "endpoint": "place"}
HEX = "0123456789abcdef" * 2
MIXED = "Ab1" * 12
KEY = "AKIA" + "ABCDEFGHIJKLMNOP"


def brute(text, scope=SCOPE):
    parts = []
    for k, rx in RX.items():
        for m in rx.finditer(text or ""):
            v = m.group(1)
            if len(v) >= LEAST[k] and (k != "mixed" or all(re.search(c, v) for c in ("[0-9]", "[a-z]", "[A-Z]"))):
                parts.append((m.start(), KINDS.index(k), k, m.end()))
    parts.sort()
    out = []
    for n, (s, r, k, e) in enumerate(parts):
        if r > 2:
            if any(x[1] <= 2 and x[0] < e and x[3] > s for x in parts):
                continue
            near = {ROLE[x[2]] for j, x in enumerate(parts) if (j < n and s - x[3] <= scope) or (j > n and x[0] - e <= scope)}
            need = {"id": {"secret"}, "secret": {"id"}, "place": {"id", "secret"}}[ROLE[k]]
            if not need <= near:
                continue
        out.append((s, r, k, e))
    return out


def text_of(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


TEXTS = [
    f"password={HEX}", f"{KEY} secret: 'abc-def_123'", "secret=token: abcdefgh", "token==abc", 'Api_Key" : "xy.z=1/2+3"', "PASSWD=short",
    f"pre 😀漢 {HEX}{HEX} and {KEY}0 and AKIA123", f"account: bob@x.example {MIXED}==", f"account: bob {'z' * 300} {MIXED}", MIXED,
    "login=alice https://db.example:5432/x", f"login=alice https://db.example:5432/x token={HEX}", f"{HEX.upper()} {HEX}g{HEX}",
    "AKIA" * 9, "password = = value1", "the secret is out; token of thanks", "ſecret=abcdefgh toKen=abcdefgh",
    " ".join(f"token=val{i:05d}" for i in range(3000)), f"client_id=abc {MIXED} client_id=def", "api_key=AbC123" + MIXED,
]


def test_brute_force(spark):
    rows = list(enumerate(TEXTS)) + [(1000 + (i or 0) if i is not None else None, t) for i, t in sample_docs()] + [(3, TEXTS[3]), (None, TEXTS[0])]
    df = scan(docs_frame(spark, rows))
    assert "Python" not in df._jdf.queryExecution().toString()
    want = []
    for i, t in rows:
        s = brute(t)
        base = [x for x in s if x[1] <= 2]
        want.append((i, *(sum(x[1] == r for x in s) for r in range(3)), text_of(base), text_of(s)))
    assert sorted((tuple(r) for r in df.collect()), key=repr) == sorted(want, key=repr)
    assert sum("mixed" in w[-1] for w in want) >= 2 and sum("endpoint" in w[-1] for w in want) >= 1


def test_redaction(spark):
    rows = list(enumerate(TEXTS)) + [(500, None), (501, ""), (502, "plain")]
    df = docs_frame(spark, rows)
    out = redact(df, mark="#")
    assert out.columns == df.columns
    for r in out.collect():
        t = dict(rows)[r.doc_id]
        cover = [False] * len(t or "")
        spans = brute(t)
        for s, _, _, e in spans:
            cover[s:e] = [True] * (e - s)
        if spans:
            groups, last = [], None
            for s, _, _, e in spans:
                if last is not None and s <= last:
                    last = max(last, e)
                    groups[-1][1] = last
                else:
                    groups.append([s, e])
                    last = e
            want, at = "", 0
            for s, e in groups:
                want += t[at:s] + "#"
                at = e
            t = want + t[at:]
        assert r.text == t


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "nothing")]])
def test_tiny(spark, rows):
    assert [tuple(r) for r in scan(docs_frame(spark, rows)).collect()] == [(i, 0, 0, 0, "", "") for i, _ in rows]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        s = brute(r.text)
        base = [x for x in s if x[1] <= 2]
        want[r.doc_id] = (*(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(s))
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in Q.op9_secret_links(spark, sf).collect()}
    assert got == want and any(w[-1] for w in want.values())


def test_redaction_minds_no_column_names(spark):
    names = ["__own", "__text", "__id", "__hash", "__spans", "__state", "__before"]
    row = (1, "password=abcdefgh and more", *range(len(names)))
    df = spark.createDataFrame([row], "doc_id long, text string, " + ", ".join(f"`{n}` long" for n in names))
    out = redact(df)
    assert out.columns == df.columns
    assert tuple(out.first()) == (1, "[SECRET] and more", *range(len(names)))
    assert scan(df).first().n_assign == 1
