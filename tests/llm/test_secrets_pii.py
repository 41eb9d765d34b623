import hashlib
import os
import random
import re
from datetime import date, timedelta

import duckdb

import pytest
from pyspark.sql import functions as F

from adlake.llm import pii_feistel as P
from adlake.llm import secret_links as S

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
TEXTS = [
    None, "", "token = abc", "token=abcdef", 'é😀 "Api_Key": "abc.def-ghi"', "secret=token:abcdefgh", "password: xxxxxx password=yyyyyyy", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIA" + "B" * 30 + "AKIA" + "C" * 16,
    "a" * 24, "0123456789abcdef0123456", "token = " + "0" * 40, "passwd='ab'\nsecret:\t no", "SECRET = TOKEN = abcdef123456", "deadbeef" * 3000,
]


def brute(t):
    t = t or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(spans)


def test_base_spans_equal_brute_force(make_docs, sample):
    docs = make_docs(TEXTS).unionByName(sample("documents").withColumn("doc_id", F.col("doc_id") + 100), allowMissingColumns=True)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = S.scan_secrets(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert sorted(map(tuple, r.base)) == brute(texts[r.doc_id])


def linked(make_docs, *texts):
    rows = sorted(S.scan_secrets(make_docs(list(texts))).collect(), key=lambda r: r.doc_id)
    return [sorted(x.kind for x in r.linked) for r in rows]


def test_weak_parts_need_their_complement(make_docs):
    key = "aB3" + "x" * 37
    far = " " * 300
    got = linked(make_docs, f"user: joe key {key}", f"user: joe {far} {key}", key, "user: joe", f"https://h.example/x {key}", "host=db1 user=joe", "login=joe password=abc", "AKIA12345 " + "0" * 16, "user=joe token=abcdefgh")
    assert got == [["identifier", "key40"], [], [], [], ["endpoint", "key40"], [], ["identifier", "short_assign"], ["short_access", "short_hex"], ["identifier"]]


def test_links_equal_all_pairs(make_docs):
    rows = []
    for k in range(40):
        rows.append("".join(("user=joe ", "token=abc ", "x" * (k * 13 % 170) + " ", "host=db ", "0" * 17 + " ")[(k * j * 7 + j) % 5] for j in range(12)))
    for r in S.scan_secrets(make_docs(rows)).collect():
        text = rows[r.doc_id]
        names = [(m.start(), m.end(), "identifier") for m in re.finditer(S.IDENTIFIER, text)] + [(m.start(), m.end(), "endpoint") for m in re.finditer(S.ENDPOINT, text)]
        weak = [(m.start(), m.end(), "short_assign") for m in ASSIGN.finditer(text) if len(m[2]) < 6] + [(m.start(), m.end(), "short_hex") for m in re.finditer("[0-9a-f]{16,}", text) if len(m[0]) < 24]
        near = lambda a, b: a[0] <= b[1] + S.SCOPE and a[1] >= b[0] - S.SCOPE
        want = [w for w in weak if any(near(w, n) for n in names)] + [n for n in names if any(near(n, w) for w in weak)]
        assert sorted((x.start, x.end, x.kind) for x in r.linked) == sorted(want)


def luhn(s):
    d = [int(c) for c in reversed(s)]
    return sum(d[0::2]) + sum(x * 2 - 9 * (x > 4) for x in d[1::2])


def masked(make_docs, *texts):
    return [r.text for r in P.mask_pii(make_docs(list(texts)), "k").orderBy("doc_id").collect()]


def test_formats_stay_valid_and_values_stay_linked(make_docs):
    card, ip, phone, day = "4845168114407329", "97.51.17.173", "+1 (017) 555-7713", "2024-02-29"
    iban = "GB82 WEST 1234 5698 7654 32"
    a, b = masked(make_docs, f"pay {card}, {ip}; {phone} {day} {iban} x@y.example.com, 078-05-1120", f"{card} {phone} {ip} {day} {iban} x@y.example.com 078-05-1120 z@y.example.com")
    for value in (card, ip, phone, day, iban, "x@y", "078-05-1120"):
        assert value not in a and value not in b
    new = re.search(r"\d{16}", a)[0]
    assert luhn(new) % 10 == 0 and new in b
    new_ip = re.search(r"\d+\.\d+\.\d+\.\d+", a)[0]
    assert new_ip in b and all(int(x) < 256 for x in new_ip.split("."))
    new_phone = re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", a)[0]
    assert new_phone in b
    new_day = re.search(r"\d{4}-\d\d-\d\d", a)[0]
    assert date.fromisoformat(new_day) and new_day in b
    new_iban = re.search(r"GB\d\d WEST[\d ]+\d", a)[0]
    digits = "".join(str(int(c, 36)) for c in (new_iban.replace(" ", "")[4:] + new_iban[:4]))
    assert int(digits) % 97 == 1 and new_iban in b
    names = re.findall(r"u\w+@(d\w+)\.invalid", b)
    assert len(names) == 2 and names[0] == names[1]
    ssn = re.search(r"\b\d{3}-\d{2}-\d{4}\b", a)[0]
    assert ssn in b and not ssn.startswith(("000", "666", "9"))


def test_invalid_numbers_and_clean_texts_stay(make_docs):
    texts = [None, "", "plain text, v1.2.3 and 12345", "4845168114407328", "999.1.1.1 1.2.3.4.5", "2024-13-45 and 2023-02-29", "a @ b", "GB82 WEST 1234 5698 7654 33", "x" * 200_000]
    assert masked(make_docs, *texts) == texts


def test_permutation_is_one_to_one(spark):
    for width in (2, 3):
        df = spark.range(10**width).select(F.lpad(F.col("id").cast("string"), width, "0").alias("d"))
        out = df.select(P.permute_digits(F.col("d"), F.lit("k"), "t").alias("p"))
        assert out.distinct().count() == 10**width and out.filter(F.length("p") != width).isEmpty()
    days = spark.range(0, 73049, 7).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "dd.MM.yyyy").alias("d"))
    out = days.select(P.pseudonym(F.col("d"), F.lit("k")).alias("p"))
    assert out.distinct().count() == days.count() and out.filter(F.try_to_date("p", "dd.MM.yyyy").isNull()).isEmpty()


def test_plans_have_no_python(make_docs):
    docs = make_docs(["x"])
    for df in (S.scan_secrets(docs), P.mask_pii(docs, "k")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_masking_keeps_rows_and_columns(make_docs):
    docs = make_docs([(None, "x"), (1, "1.2.3.4"), (1, "1.2.3.4")])
    out = P.mask_pii(docs, "k")
    assert out.columns == docs.columns and out.count() == 3
    assert P.mask_pii(docs.limit(0), "k").count() == 0


@pytest.mark.parametrize("text", ["7536784127813050 4845168114407329", "1 4845168114407329"])
def test_neighbouring_numbers(make_docs, text):
    (out,) = masked(make_docs, text)
    assert "4845168114407329" not in out


NUMBERS = ["+49 30 1234567", "+49 170 1234567", "+49-89-123456", "+33 612345678", "+86 13812345678", "+49.30.1234567", "+33 6 12 34 56 78", "+33 1.42.68.53.10", "+45 12.34.56.78", "+44 (0)20 7946 0958", "+4930123456", "+49 89 1234-0"]


def test_phone_groups_of_any_length_are_masked_whole(make_docs):
    out = masked(make_docs, *(f"call {n} 5 times." for n in NUMBERS))
    for n, text in zip(NUMBERS, out):
        assert [m[0] for m in re.finditer(P.ANY, f"call {n} 5 times.")] == [n]
        assert n not in text and re.sub("[0-9]", "9", text[5:-9]) == re.sub("[0-9]", "9", n) and text.endswith(" 5 times.")


ONE_NUMBER = [
    ("+49 151 1234567", "+491511234567", "+49-151-1234567", "+49 1511234567", "+49 (0)151 1234567", "+49.151.1234567", "+49 15 11 23 45 67"),
    ("+1 555 123 4567", "+15551234567", "+1 (555) 123-4567", "+1-555-123-4567", "+1.555.123.4567"),
    ("+358 40 1234567", "+358401234567", "+358-40-1234567"),
    ("+7 495 1234567", "+74951234567", "+7 (495) 1234567"),
]


@pytest.mark.parametrize("written", ONE_NUMBER)
def test_a_number_has_one_pseudonym_however_it_is_grouped(make_docs, written):
    code = written[0].split()[0]
    out = [x[5:-1] for x in masked(make_docs, *(f"call {n}." for n in written))]
    assert len({re.sub(r"[^0-9]", "", x.replace("(0)", "")) for x in out}) == 1 and all(x.startswith(code) for x in out)
    assert not set(out) & set(written) and [re.sub("[1-9]", "0", x) for x in out] == [re.sub("[1-9]", "0", n) for n in written]


def test_a_number_within_its_country_is_the_same(make_docs):
    a, b = masked(make_docs, "call +1 (555) 123-4567.", "call (555) 123-4567.")
    assert a[8:] == b[5:]


@pytest.mark.parametrize("next_token", ["10.0.0.1", "2024-02-29", "29.02.2024", "4845 1681 1440 7329", "078-05-1120", "555-123-4567"])
def test_a_phone_number_takes_no_following_value(next_token):
    for n in ("+49 30 12345", "+49 30 1234567", "+49-89-123456"):
        assert [m[0] for m in re.finditer(P.ANY, f"{n} {next_token}")] == [n, next_token]


@pytest.mark.parametrize("iban", ["BE68 5390 0754 7034", "ES9121000418450200051332", "XX83 1234 5678 9012 3456"])
def test_an_iban_takes_no_following_token(make_docs, iban):
    tails = ["", " OK", " BIC", " 5 times", " SEPA", " 2024 12"]
    out = masked(make_docs, *(f"to {iban}{t}" for t in tails))
    new = out[0][3:]
    assert new != iban and int("".join(str(int(c, 36)) for c in new.replace(" ", "")[4:] + new[:4])) % 97 == 1
    assert out == [f"to {new}{t}" for t in tails]


def test_a_card_behind_something_like_an_iban_is_masked(make_docs):
    out = masked(make_docs, "BE68 5390 0754 7034 4845 1681 1440 7329", "AB12 4845 1681 1440 7329", "AB12 4845 1681 1440 7328")
    assert all("4845" not in x for x in out[:2]) and out[1].startswith("AB12 ") and out[2] == "AB12 4845 1681 1440 7328"


def test_scan_equals_sql(spark):
    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for n in os.listdir(sf):
        con.sql(f"CREATE VIEW {n.split('.')[0]} AS SELECT * FROM '{sf}/{n}'")
    got, want = S.query(spark, sf).toPandas(), con.sql(S.ORACLE_SQL).df()
    key = lambda d: sorted(map(repr, d[sorted(d.columns)].astype(object).itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_sql_links_weak_parts_alike(make_docs):
    parts = ("user=joe ", "token=abc ", "host=db ", "0" * 17 + " ", "aB3" + "x" * 37 + " ", "AKIA12345 ", "y" * 150 + " ", "AKIA" + "Z" * 18 + " ", "=aB3" + "x" * 37 + " ", "é😀 ")
    r = random.Random(2)
    texts = ["".join(r.choice(parts) for _ in range(10)) for _ in range(60)]
    docs = make_docs(texts)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = {i: s for i, s in con.sql(f"SELECT doc_id, spans FROM ({S.ORACLE_SQL})").fetchall()}
    got = {x.doc_id: ",".join(f"{p.kind}:{p.start}:{p.end}" for p in sorted([*x.base, *x.linked], key=lambda p: (p.start, p["rank"], p.end))) for x in S.scan_secrets(docs).collect()}
    assert got == want and any("key40" in s for s in got.values()) and any("short_access" in s for s in got.values())


def test_text_of_many_matches(make_docs):
    n = 20_000
    (r,) = S.scan_secrets(make_docs(["0123456789abcdef01 user=joe " * n])).selectExpr("size(linked) AS n", "linked[39999].end AS last").collect()
    assert (r.n, r.last) == (2 * n, 28 * n - 1)


class Plain:
    """The permutations of the module's text, one value at a time."""

    def __init__(self, key):
        self.key = key

    def feistel(self, kind, a, b, size_a, size_b):
        for i in range(1, 11):
            digest = int(hashlib.sha256(f"{self.key}|{kind}|{i}|{b}".encode()).hexdigest()[:15], 16)
            a, b = b, (a + digest) % (size_a if i % 2 else size_b)
        return a, b

    def digits(self, kind, d):
        n, u = len(d), len(d) // 2
        if n < 2:
            return d
        a, b = self.feistel(f"{kind}{n}", int(d[:u]), int(d[u:]), 10**u, 10 ** (n - u))
        return f"{a:0{u}}{b:0{n - u}}"

    def like(self, value, digits):
        it = iter(digits)
        return "".join(next(it) if c.isdigit() else c for c in value)

    def card(self, m):
        body = self.digits("card", re.sub("[^0-9]", "", m)[:-1])
        return self.like(m, body + str(-luhn(body + "0") % 10))

    def phone(self, m):
        m = m.replace("(0)", "(o)")
        digits = re.sub("[^0-9]", "", m)
        two = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
        n = 0 if m[0] != "+" else 1 if digits[0] in "17" else 2 if digits[:2] in two else 3
        return self.like(m, digits[:n] + self.digits("phone", digits[n:])).replace("(o)", "(0)")

    def ssn(self, m):
        d = m.replace("-", "")
        while True:
            d = self.digits("ssn", d)
            if d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000":
                return self.like(m, d)

    def ipv4(self, m):
        p = list(map(int, m.split(".")))
        a, b = self.feistel("ipv4", p[0] * 256 + p[1], p[2] * 256 + p[3], 65536, 65536)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"

    def iso(self, m):
        first = date(1900, 1, 1)
        x = (date.fromisoformat(m) - first).days
        while True:
            a, b = self.feistel("date", x // 271, x % 271, 271, 271)
            x = a * 271 + b
            if x < 73049:
                return str(first + timedelta(days=x))

    def iban(self, m):
        body = m[4:]
        new = self.like(body, self.digits("iban", re.sub("[^0-9]", "", body)))
        number = int("".join(str(int(c, 36)) for c in new + m[:2] + "00"))
        return f"{m[:2]}{98 - number % 97:02}{new}"


def test_pseudonyms_equal_a_plain_version(make_docs):
    r, plain, cases = random.Random(7), Plain("k"), []
    for _ in range(25):
        body = "4" + "".join(r.choice("0123456789") for _ in range(14))
        card = body + str(-luhn(body + "0") % 10)
        cases += [("card", card), ("card", " ".join(card[k : k + 4] for k in range(0, 16, 4))), ("phone", f"+1 ({r.randrange(200, 999)}) {r.randrange(200, 999)}-{r.randrange(1000, 9999)}"), ("phone", f"+49 30 {r.randrange(1000000, 9999999)}")]
        cases += [("ssn", f"{r.randrange(100, 600):03}-{r.randrange(1, 99):02}-{r.randrange(1, 9999):04}"), ("ipv4", ".".join(str(r.randrange(256)) for _ in range(4))), ("iso", str(date(1900, 1, 1) + timedelta(days=r.randrange(73049))))]
        bban = "WEST" + "".join(r.choice("0123456789") for _ in range(14))
        cases.append(("iban", f"GB{98 - int(''.join(str(int(c, 36)) for c in bban + 'GB00')) % 97:02}{bban}"))
    got = masked(make_docs, *(f"see {v} now" for _, v in cases))
    assert got == [f"see {getattr(plain, kind)(v)} now" for kind, v in cases]
