import re
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kontor.llm import pii, queries, url_filter

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    return [
        f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "", re.ASCII) if holds(kind, m[0])
    ]


def check(docs):
    for row in pii.pii(docs).join(docs.select(F.col("doc_id").alias("k"), "text"),
                                  F.expr("doc_id <=> k")).collect():
        want = base(row["text"])
        assert row["base_sha256"] == sha256(",".join(want).encode()).hexdigest(), (row["text"], row["spans"])
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(x.startswith(kind + ":") for x in want)
        assert [x for x in row["spans"].split(",") if x.split(":")[0] in PATTERNS] == want


def test_whole_texts(spark, documents, odd, nothing):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    check(odd.filter("doc_id IS NOT NULL AND doc_id <> 7"))
    assert pii.pii(odd).count() == odd.count()
    assert pii.pii(nothing).count() == 0
    assert pii.with_spans(odd, out="found").columns == [*odd.columns, "found"]


PIECES = st.sampled_from([
    "1", "12", "4111111111111111", "4111 1111 1111 1111", "255", "256", ".", "..", " ", "  ", "-",
    "+", "@", "a", "b.c", "x_y", "%", "(", ")", "é", "\U0001f600", "\n", "00", "1.2.3.4", "ab@cd.ef",
    "+1 (234) 555-6789", "0", "10.0.0.1", "0.0.0.0", "1.00.000.1",
])


@settings(max_examples=20, deadline=None)
@given(texts=st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=40, max_size=60))
def test_made_up_texts(spark, texts):
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_addresses_with_zeros(spark):
    texts = ["10.0.0.1", "0.0.0.0", "1.00.000.1", "127.0.0.1 or 192.168.0.1", "0255.00.010.099",
             "256.0.0.1", "0.0.0.0256", "0.0.0.300", "0.0.0", "0" * 3000 + ".0.0." + "0" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    check(docs)
    rows = sorted((r["doc_id"], r["n_ip"]) for r in pii.pii(docs).collect())
    assert [n for _, n in rows] == [1, 1, 1, 2, 1, 0, 0, 0, 0, 1]


def test_added_spans(spark):
    texts = [
        "Konto DE89370400440532013000 bitte", "Konto DE89370400440532013001 bitte",
        "GB82 WEST 1234 5698 7654 32", "ssn: 123-45-6789", "part 123-45-6789", "9" * 30_000,
        "a" * 100_000 + "@", "1 " * 30_000,
    ]
    rows = pii.pii(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    spans = [row["spans"] for row in sorted(rows)]
    assert spans[0] == "iban:6:28" and spans[1] == "" and "iban:0:27" in spans[2]
    assert spans[3:] == ["ssn:5:16", "", "", "", ""]


def test_added_spans_in_running_text(spark):
    tight, wide = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    cases = {
        f"{tight} Please pay": ["iban:0:22"], f"{tight} P": ["iban:0:22"], f"{tight} 12 x": ["iban:0:22"],
        f"{wide} BIC COBADEFF": ["iban:0:27"], f"To {wide} 2024 EUR": ["iban:3:30"], f"{wide} a": ["iban:0:27"],
        f"{wide} Bic": ["iban:0:27"], f"{wide} {tight} GB82 WEST 1234 5698 7654 32 OR {tight}":
            ["iban:0:27", "iban:28:50", "iban:51:78", "iban:82:104"],
        f"AB12 {tight} OK": ["iban:5:27"], f"{tight}X": [], f"{tight}x": [], f"x{tight}": [],
        "NO93 8601 1117 947 ABCDE": ["iban:0:18"], "DE89 3704 0044 0532 0130 01 BIC": [],
        "ssn 123-45-6789, 987-65-4321": ["ssn:4:15", "ssn:17:28"],
        "ssn 123-45-6789" + " " * 60 + "987-65-4321": ["ssn:4:15"],
        "ssn " + "123-45-6789 " * 6: [f"ssn:{4 + 12 * n}:{15 + 12 * n}" for n in range(4)],
        "\U0001f600 é " + f"{tight} P " * 3: [f"iban:{4 + 25 * n}:{26 + 25 * n}" for n in range(3)],
        "AB12 " * 20_000: [],
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    rows = sorted((r["doc_id"], r["spans"]) for r in pii.pii(docs).collect())
    for (_, spans), (text, want) in zip(rows, cases.items()):
        assert [x for x in spans.split(",") if x[:4] in ("iban", "ssn:")] == want, text[:80]


def test_redacted(spark):
    docs = spark.createDataFrame([(1, "é a@b.example.com, 1.2.3.4!"), (2, None), (3, "clean")],
                                 "doc_id bigint, text string")
    assert [r["text"] for r in pii.redacted(docs).orderBy("doc_id").collect()] == [
        "é <email>, <ip>!", None, "clean"]


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


URLS = [
    None, "", "no scheme/en/", "http://", "http://NET", "http://a.NET/", "https://x.example.net/en/a?b#c",
    "https://example.net/en", "http://example.com/de/?x", "ftp://myexample.com/de/", "http://a.org?/fr/",
    "http://a.org/fr/x://b.net/", "http://é.net/\U0001f600", "http://.net/", "http://net./", "a://b://c.net/",
]


def test_urls(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url")
    pages = pages.union(spark.createDataFrame([(-1 - n, u) for n, u in enumerate(URLS)], "page_id bigint, url string"))
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    want = sorted((r["page_id"], *judge(r["url"], queries.URL_RULES)) for r in pages.collect())
    assert sorted(map(tuple, url_filter.judged(pages, rules).collect())) == want
    assert sorted(map(tuple, url_filter.by_join(pages, rules, [1, 4]).collect())) == want
    assert url_filter.judged(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_filter.judged(pages, rules.limit(0)).collect()} == {"allow"}
