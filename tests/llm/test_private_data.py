import hashlib
import re

from tests.llm.conftest import rows_of
from tidelake.llm import private_data as p


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if k % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn(re.sub("[^0-9]", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def brute(text):
    spans = [(m.start(), k, name, m.end()) for k, (name, (pattern, fine)) in enumerate(PATTERNS.items()) for m in re.finditer(pattern, text or "") if fine(m.group())]
    counts = [sum(s[2] == name for s in spans) for name in PATTERNS]
    return counts, ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(spans))


TRICKY = [
    "a.b@c.d e@f @g.h i@@j.k l@m..n o@p.q@r.s x_y@z.w", "1.2.3.4 1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.4 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111111",
    "+1 (499) 555-6503 +12 +1.2.3.4.5.6.7.8.9.0 +1 2 3 +49 30 1234567 x", "a" * 3000 + "@", "1" * 3000, "." * 500 + "@a.b", "+1" * 200, "é@a.b 日本+1 (702) 555-0742", "@a.b@c.d", "a@b.c-d.e_f@g.h",
]


def test_base_spans_against_the_patterns(spark, small_docs, odd_docs):
    tricky = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY)], "doc_id long, text string")
    for docs in (small_docs, odd_docs, tricky, spark.read.parquet("/root/testdata/sf0.01/documents.parquet")):
        want = []
        for doc_id, text in rows_of(docs.select("doc_id", "text")):
            counts, spans = brute(text)
            want.append((doc_id, *counts, hashlib.sha256(spans.encode()).hexdigest()))
        rows = p.private_spans(docs)
        assert sorted(map(str, rows_of(rows.drop("spans", "n_found")))) == sorted(map(str, want))


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    """Cards stand behind one word; numbers of that shape there which fail the checksum are found, others are not."""
    valid = [n for n in range(4_000_000_000_000_000, 4_000_000_000_000_600) if luhn(str(n))][:30]
    rows = [(i, f"please charge card {n} today thanks") for i, n in enumerate(valid)]
    rows += [(100, "please charge card 4000000000000001 today thanks"), (101, "the number 4000000000000001 alone"), (102, "nothing here"), (103, "in 2024 there were 12345 of 1999")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in p.private_spans(docs).collect()}
    assert got[100].spans == "card:19:35" and got[100].n_card == 0 and got[100].n_found == 1
    assert got[100].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert [got[i].spans for i in (101, 102, 103)] == ["", "", ""]
    assert all(got[i].spans == "card:19:35" and got[i].n_found == 0 for i in range(30))


def test_patterns_without_faith_are_dropped(spark):
    """As many other numbers as cards in the same place: the pattern says nothing."""
    valid = [n for n in range(4_000_000_000_000_000, 4_000_000_000_000_400) if luhn(str(n))][:20]
    rows = [(i, f"charge {n} today") for i, n in enumerate(valid)] + [(100 + i, f"charge {n + 1} today") for i, n in enumerate(valid)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_found for r in p.private_spans(docs).collect()} == {0}


def test_contexts_find_identifiers_of_other_shapes(spark):
    """Phones without the plus, spaced cards and addresses that the fixed patterns miss, behind and before the words of many seeds."""
    valid = [n for n in range(4_000_000_000_000_000, 4_000_000_000_000_900) if luhn(str(n))][:40]
    rows = [(i, f"please call +1 (7{i:02}) 555-3{i:03} tonight") for i in range(40)]
    rows += [(100 + i, f"write to user{i}.x@mail{i}.example.com soon") for i in range(40)]
    rows += [(200 + i, f"charge card {n} today") for i, n in enumerate(valid)] + [(300 + i, f"server 10.1.{i}.7 answers") for i in range(40)]
    want = {
        1000: ("please call (743) 555-3824 tonight", "phone", "(743) 555-3824"), 1001: ("please call 743-555-3824 tonight", "phone", "743-555-3824"),
        1002: ("now write to user@host soon", "email", "user@host"), 1003: ("now write to user at host soon", "email", "user at host"),
        1004: ("charge card 4000 0000 0000 0001 today", "card", "4000 0000 0000 0001"), 1005: ("server a.1.2 answers", "ip", "a.1.2"),
        1006: ("write to user at host dot org soon", "email", "user at host dot org"), 1007: ("please call 743 555 3825, 7 times", "phone", "743 555 3825"),
    }
    none = {2000: "they were at home in 1999 and 743 555 3824 of 12", 2001: "please read 7 books tonight"}
    docs = spark.createDataFrame(rows + [(i, t) for i, (t, _, _) in want.items()] + list(none.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in p.private_spans(docs).collect()}
    for i, (text, kind, value) in want.items():
        assert (got[i].spans, got[i].n_found) == (f"{kind}:{text.index(value)}:{text.index(value) + len(value)}", 1), text
    assert [got[i].spans for i in none] == ["", ""] and all(got[i].n_found == 0 for i, _ in rows)


def test_believed_values_make_further_patterns(spark):
    """Numbers found beside seeds stand behind a word that no seed has; what else stands there is found in the next generation."""
    seeds = [f"dial +1 (7{i:02}) 555-3{i:03} tonight" for i in range(60)]
    known = [f"7{i:02}-555-4{i:03}" for i in range(12)]
    texts = [*seeds, *(f"dial {n} tonight" for n in known), *(f"hotline {n} morning" for n in known), "hotline 799-555-4999 morning", "desk 799-555-4998 morning"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in p.private_spans(docs).collect()}
    assert all(got[i].n_found == (i >= 60) for i in range(84))
    assert got[84].spans == "phone:8:20"


def test_long_words_with_a_common_beginning_are_distinct(spark):
    def nodes(text):
        (found,) = p.candidates(text, p.base_spans(text))
        return found[3:]

    long = "x" * 300
    values = [nodes(f"mail {long}{i}@host now")[0] for i in range(3)]
    assert len(set(values)) == 3 and max(map(len, values)) < 200
    assert not set(nodes(f"{long}a 12345 {long}b")[1]) & set(nodes(f"{long}c 12345 {long}d")[1])
    one, other = (nodes(f"left {'-1' * 60}{end} right")[1] for end in ("-1", "_1"))
    assert len(set(one) - set(other)) == 3  # the shapes, on either side and both


def test_clean_texts_and_no_rows(small_docs, no_docs):
    spans = p.private_spans(small_docs).toPandas()
    clean = {i for i, t in rows_of(small_docs.select("doc_id", "text")) if not re.search("[0-9@]", t or "")}
    assert set(spans[spans.doc_id.isin(clean)].spans) == {""}
    assert p.private_spans(no_docs).collect() == []
