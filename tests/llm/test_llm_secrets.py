"""Secret scans: patterns against a scan letter by letter, planted settings, edge cases, time."""

import hashlib
import random
import time

import pytest

from personpub.llm.catalog import QUERIES
from personpub.llm.secrets import Reader, base_spans, find_secrets, literal_score, scan, sensitivity

VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")


def lower(c):
    return chr(ord(c) + 32) if "A" <= c <= "Z" else c


def brute(text):
    out, low = [], "".join(map(lower, text))
    i = 0
    while i < len(text):
        name = next((n for n in NAMES if low.startswith(n, i)), None)
        j = i + len(name or "")
        j += text[j : j + 1] in ("'", '"') and j < len(text)
        while text[j : j + 1] == " ":
            j += 1
        if not name or text[j : j + 1] not in (":", "="):
            i += 1
            continue
        j += 1
        while text[j : j + 1] == " ":
            j += 1
        j += text[j : j + 1] in ("'", '"') and j < len(text)
        k = j
        while k < len(text) and text[k] in VALUE:
            k += 1
        if k == j:
            i += 1
            continue
        out += [("assign", i, k)] if k - j >= 6 else []
        i = k
    for kind, head, letters, least in (
        ("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20), ("hex", "", set("0123456789abcdef"), 24)
    ):
        i = 0
        while i < len(text):
            j = i + len(head)
            while text.startswith(head, i) and j < len(text) and text[j] in letters:
                j += 1
            if j == i + len(head):
                i += 1
                continue
            out += [(kind, i, j)] if j - i >= least else []
            i = j
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def base(text):
    return sorted(((s.kind, s.start, s.end) for s in base_spans(text)), key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_patterns_as_letter_by_letter():
    rng = random.Random(4)
    bits = [*NAMES, "Token", "API_KEY", "paſsword", "toKen", "=", ":", " ", '"', "'", "x", "abcdef", "0123456789", "AKIA",
            "ABCDEF0123456789", "é", "\n", "-", "deadbeef00", "日"]
    for _ in range(4000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize(
    "text, found",
    [
        ('DB = "s3cr3t-Pa55!"\npassword = DB\n', ["s3cr3t-Pa55!"]),  # carried through a constant
        ('a = "Xk9#qq-1"\nb = a + "mQ2!vv"\nAPI_SECRET_KEY = b\n', ["Xk9#qq-1", "mQ2!vv"]),  # joined parts
        ('x = y = "Zr8!kk2Pq"\nuser_pwd = x\n', ["Zr8!kk2Pq"]),
        ('a = "Old9!kk2Pq"\na = "New9!kk2Pq"\npwd = a\n', ["New9!kk2Pq"]),  # the last setting before the use
        ('pwd = LATER\nLATER = "Kk3_!!ab9X"\n', ["Kk3_!!ab9X"]),
        ('PASSPHRASE=${DEFAULT_PP}\nDEFAULT_PP="kQ9-zz81-LLp"\n', ["kQ9-zz81-LLp"]),
        ('{"auth": {"clientSecret": "aB3$kk92Lz", "type": "basic9!Zk"}, "n": "Zz9!kk2Pq"}', ["aB3$kk92Lz"]),
        ('secrets:\n  db: "qW8#zzP0m"\nname: "zzTop77!!"\n', ["qW8#zzP0m"]),
        ("<passphrase>Corr3ct-H0rse!</passphrase>", ["Corr3ct-H0rse!"]),
        ('const privateKey = process.env.PK || "f4K!x9Qz77";', ["f4K!x9Qz77"]),
        ("export DB_PASS=Sup3rS3cret\n", ["Sup3rS3cret"]),
        ('password_hint = "Zz9!kk2Pq"', []),
        ("passphrase = changeme", []),
        ("don't say: it's a token of love: yes, really", []),
        ('greeting = "Zz9!kk2Pq"\n', []),
        ('pwd = pwd\n', []),
        ('a = b\nb = a\npwd = a\nb = "Zz9!kk2Pq"', []),  # a circle: the first setting of b counts for a
        ('a = b\npwd = a\nb = "Zz9!kk2Pq"', ["Zz9!kk2Pq"]),
    ],
)
def test_literals_of_sensitive_names(text, found):
    shifted = "é日😀 \n" + text
    for t in (text, shifted):
        assert [t[s.start : s.end] for s in scan(t) if s.kind == "literal"] == found


def test_base_spans_stay_and_cover():
    text = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    assert [s.kind for s in scan(text)] == ["assign", "hex"]
    text = "db_password: hunter2!x9"
    assert [(s.kind, s.start) for s in scan(text)] == [("assign", 3), ("literal", 13)]


def test_scores():
    assert sensitivity("userPassword") == sensitivity("AWS_SECRET_ACCESS_KEY") == 1
    assert sensitivity("tokenType") == sensitivity("primary_key") == sensitivity("9") == 0
    assert literal_score("xxxxxxxx") == literal_score("${NAME}") == literal_score("your_password") == 0
    assert literal_score("kQ9-zz81-LLp") > literal_score("correct") > 0


def test_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, 'pwd = "Zz9!kk2Pq"'), (3, 'pwd = "Zz9!kk2Pq"'), (None, "token=abcdef"), (5, "a=b " * 90_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS kind")
    got = {(r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"])) for r in find_secrets(df).collect()}
    assert got == {(1, ()), (2, ()), (3, (("literal", 7, 16),)), (None, (("assign", 0, 12),)), (5, ())}
    assert find_secrets(df).count() == 6 and find_secrets(df.limit(0)).collect() == []
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    told = {r["doc_id"]: r for r in QUERIES["op11_secrets"](spark, str(tmp_path)).collect()}
    assert told[3]["spans"] == "literal:7:16" and told[3]["n_assign"] == 0
    assert told[3]["base_sha256"] == told[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_as_letter_by_letter(spark, sf):
    sf_dir = f"/root/testdata/{sf}"
    got = {r["doc_id"]: r for r in QUERIES["op11_secrets"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(got)
    for doc_id, text in docs:
        want, r = brute(text or ""), got[doc_id]
        kinds = [k for k, _, _ in want]
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [kinds.count(k) for k in ("assign", "access", "hex")]
        told = [f"{k}:{a}:{b}" for k, a, b in want]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("literal")] == told


@pytest.mark.parametrize(
    "part", ['"', "token ", '"a', "a=", "a.b", "<a>", "'\\", "${a:", "a: ", "a = {", "x =" + " " * 300, "a=b,", "{{ ", "a=a\n", "[("]
)
def test_time_grows_with_the_length(part):
    def seconds(n):
        text = part * (n // len(part))
        start = time.perf_counter()
        scan(text)
        return time.perf_counter() - start

    assert seconds(400_000) < 60 * seconds(20_000) + 1


def test_a_name_in_use_keeps_its_setting():
    r = Reader('a = "one"\nb = a\na = "two"\n')
    assert [(s.name, s.parts) for s in r.settings] == [("a", []), ("b", [0]), ("a", [])]
