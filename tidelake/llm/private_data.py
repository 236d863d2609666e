"""Personal data by fixed patterns, extended by bootstrapped contextual extraction.

The fixed patterns find seed entities. A seed's neighbouring words, with its shape, with a coarse class or alone, make lexical
patterns; everything else like an identifier makes the same kind of patterns, over several words as the seeds. Spark scores the graph of patterns and instances in rounds: a pattern
is as good as the share of its instances that are believed, an instance is believed if one of its patterns is good; believed
instances count as seeds of the next round.
Patterns that end above the limit mark the unseen identifiers that they hold.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import settle, slices, table, texts_of

#: In the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
SLICE = 8 << 20
#: Rounds at most, and the movement of a score below which it stands still.
ROUNDS = 10
STILL = 0.001
#: Instances (distinct words) that a pattern must have, how many of them seeds or believed, and the score that it must reach.
MIN_INSTANCES = 5
MIN_SEEDS = 3
CONFIDENCE = 0.8
#: Weight of doubt: so many unbelieved instances are added to each pattern.
DOUBT = 0.5

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts at the first digit of a run, so later digits of the run need no try.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9@]")
#: What a text without candidates lacks.
_HINT = re.compile(r"[0-9@]|(?<![^\x20\x09-\x0D])[\[({<]?[aA][tT][\])}>]?(?![^\x20\x09-\x0D])")
#: Words; those without a digit or @ in the first group.
_WORD = re.compile(r"([^\x20\x09-\x0D0-9@]++(?![^\x20\x09-\x0D]))|[^\x20\x09-\x0D]+")
#: Words of a number written in several: the first ones end in a digit or bracket. Words that only join two of them.
_NUMBER = re.compile(r"[^\w@]*[0-9][0-9()\[\]./+-]*[^\w@]*")
_GOES_ON = re.compile(r".*[0-9)\]]\Z", re.DOTALL)
_JOINS = frozenset("-./–")
_AT = frozenset(left + "at" + right for left, right in ("[]", "()", "{}", "<>")) | {"at"}
_DOT = frozenset(("dot", "(dot)", "[dot]", "{dot}", "<dot>"))
_USER = re.compile(r"[^\W_](?:[\w.%+-]*\w)?\Z")
#: Characters of a value, shape or neighbouring word beyond which a hash stands for it.
LONG = 48
#: Digits of the longest number that is taken over several words, as of a card.
MOST_DIGITS = 19
_EDGE = "\"'`.,;:!?()[]{}<>|#*$%&="


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the longest run of name characters before it, and a domain behind it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every valid match of the fixed patterns, in order."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for found in _IP.finditer(text):
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in found.group().split(".")):
                spans.append((found.start(), 1, found.end()))
        for found in _CARD.finditer(text):
            digits = found.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((found.start(), 2, found.end()))
        for found in _PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in found.group()) <= 15:
                spans.append((found.start(), 3, found.end()))
    return sorted(spans)


def shape(word: str) -> str:
    """A word with runs of digits as 9 and their length (up to 20), runs of letters as a, everything else as it is."""
    out = re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 20)}", word)
    return re.sub(r"[^\W\d_]+", "a", out)


def node(text: str) -> str:
    """A text as the key of a node: itself, or a hash of all of it where it is long."""
    return text if len(text) <= LONG else f"#{hashlib.blake2b(text.encode('utf-8', 'surrogatepass'), digest_size=16).hexdigest()}"


def _context(word: str) -> str:
    return node(word.strip(_EDGE).lower())


def classes(value: str) -> list[str]:
    """The coarse classes of a value: an address, dotted, or by its count of digits; numbers may be in two."""
    if "@" in value or not _DIGIT.search(value):
        return ["@"]
    digits = sum("0" <= c <= "9" for c in value)
    kind = "x" if re.search(r"[^\W\d_]", value) else ""
    out = ["dots"] if max(value.count("."), value.count(":")) > 1 else []
    ranges = (("few", 1, 3), ("some", 4, 6), ("phone", 7, 15), ("card", 13, MOST_DIGITS), ("many", MOST_DIGITS + 1, digits))
    return out + [kind + name for name, low, high in ranges if low <= digits <= high]


def _patterns(value: str, before: str, after: str) -> list[str]:
    """The word on the left, the one on the right, or both, each with the coarse classes and with the shape; both alone."""
    forms = [f"C{c}" for c in classes(value)] + [f"S{node(shape(value))}"]
    sides = [f"L {before}"] * bool(before) + [f"R {after}"] * bool(after) + [f"B {before} {after}"] * bool(before and after)
    return [f"{side} {form}" for side in sides for form in forms] + [f"A {before} {after}"] * bool(before and after)


def _addresses(text: str, words: list[tuple[int, int]], k: int, free: list[bool]) -> int:
    """The last word of an address written around word k, as user at host dot org or user @ host; k if there is none."""
    if not 0 < k < len(words) - 1 or not (free[k - 1] and free[k] and free[k + 1]):
        return k
    if not (_USER.match(text[slice(*words[k - 1])]) and _USER.match(text[slice(*words[k + 1])].rstrip(_EDGE))):
        return k
    last = k + 1
    while last + 2 < len(words) and free[last + 1] and free[last + 2] and text[slice(*words[last + 1])].lower() in _DOT:
        last += 2
    return last


def _unseen(text: str, words: list[tuple[int, int]], hot: list[int], free: list[bool]) -> Iterator[tuple[int, int]]:
    """First and last word of everything like an identifier: words with a digit or @, numbers and addresses over several words.

    Of a run of number words these are the words, and the run and its beginnings and ends of up to MOST_DIGITS digits.
    """
    done = -1
    for k in hot:
        if not free[k]:
            continue
        word = text[slice(*words[k])]
        if word == "@" or word.lower() in _AT:
            last = _addresses(text, words, k, free)
            if last > k:
                yield k - 1, last
            continue
        yield k, k
        if word.endswith("@") and k + 1 < len(words) and free[k + 1]:
            yield k, k + 1
        if k <= done or not _NUMBER.fullmatch(word):
            continue
        run, at = [k], k
        while _GOES_ON.match(text[slice(*words[at])]):
            following = at + 2 if at + 2 < len(words) and free[at + 1] and text[slice(*words[at + 1])] in _JOINS else at + 1
            if following >= len(words) or not free[following] or not _NUMBER.fullmatch(text[slice(*words[following])]):
                break
            if text[words[at][1] : words[following][0]].strip(" -./–"):
                break
            run.append(following)
            at = following
        done = run[-1]
        digits = [sum("0" <= c <= "9" for c in text[slice(*words[w])]) for w in run]
        for order in (range(len(run)), range(len(run) - 1, -1, -1)):
            total, first = 0, order[0]
            for n, w in enumerate(order):
                total += digits[w]
                if total > MOST_DIGITS:
                    break
                # One word was taken before; the whole run is taken once, from its start.
                if n and (order.step > 0 or w):
                    yield run[min(first, w)], run[max(first, w)]


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """(start, end, kind or -1, value, patterns) of the seeds and of all else that is like an identifier; the latter may overlap."""
    if not _HINT.search(text):
        return []
    words, hot = [], []
    for m in _WORD.finditer(text):
        word = m.span()
        if m.lastindex is None or (word[1] - word[0] <= 4 and m.group().lower() in _AT):
            hot.append(len(words))
        words.append(word)
    starts, free = [a for a, _ in words], [True] * len(words)
    found: list[tuple[int, int, int, int, int]] = []  # start, end, kind, first and last word
    for start, kind, end in spans:
        first, last = bisect_right(starts, start) - 1, bisect_right(starts, end - 1) - 1
        free[first : last + 1] = [False] * (last + 1 - first)
        found.append((start, end, kind, first, last))
    for first, last in _unseen(text, words, hot, free):
        inner = text[words[first][0] : words[last][1]]
        start = words[first][0] + len(inner) - len(inner.lstrip(_EDGE))
        end = words[first][0] + len(inner.rstrip(_EDGE))
        if start < end and text[start - 1 : start] == "(" and start > words[first][0] and ")" in text[start:end]:
            start -= 1
        if start < end:
            found.append((start, end, -1, first, last))
    out = []
    for start, end, kind, first, last in sorted(found):
        value = text[start:end]
        before = _context(text[slice(*words[first - 1])]) if first else ""
        after = _context(text[slice(*words[last + 1])]) if last + 1 < len(words) else ""
        out.append((start, end, kind, node(value), _patterns(value, before, after)))
    return out


def _joined(spans: Iterable[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


_FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "unseen array<struct<start:long,end:long,kind:int,value:string,patterns:array<string>>>"
)
_CANDIDATE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))


def _find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "unseen"]
    kinds = [pa.int64()] * 5 + [pa.string(), _CANDIDATE]
    for batch in slices(batches, "text", SLICE):
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            spans = base_spans(text)
            counts = [sum(kind == k for _, kind, _ in spans) for k in range(4)]
            unseen = [dict(zip(("start", "end", "kind", "value", "patterns"), c, strict=True)) for c in candidates(text, spans)]
            rows.append((doc_id, *counts, _joined((a, b, KINDS[k]) for a, k, b in spans), unseen))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def good_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind and score of the patterns that bootstrapping trusts.

    ``edges`` has distinct (pattern, value, kind), kind -1 for values that no fixed pattern knows. In each round a pattern belongs
    to the kind of most of the belief in its values, seeds or not, so that values found in one round make patterns eligible
    in the next. Scores: of a pattern the mean belief in its values, with some doubt added; of an unknown
    value that of its best pattern, if it reaches the limit (a value's patterns share a context, so they are no independent
    witnesses). Values that are seeds of another kind count against a pattern. The rounds end when no pattern passes anew and no
    score moves by more than STILL, or after ``rounds``.
    """
    # The number of a pattern's values never changes, so smaller patterns can be left out from the start.
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_INSTANCES)
    graph = settle(edges.join(sizes, "pattern"))
    unknown = graph.filter("kind < 0").drop("kind")
    sums = [F.sum("support").alias("support"), F.sum("good").alias("good")]
    seeds = graph.filter("kind >= 0").groupBy("pattern", "n", F.col("kind").alias("of")).agg(F.count(F.lit(1)).alias("support"))
    seeds = settle(seeds.withColumn("good", F.col("support").cast("double")))
    support, patterns = seeds, None
    for _ in range(rounds):
        best = F.max_by(F.struct("of", "support", "good"), F.struct("good", -F.col("of"))).alias("best")
        owned = support.groupBy("pattern", "n").agg(best).select("pattern", "n", "best.*")
        scored = owned.withColumn("score", F.col("good") / (F.col("n") + DOUBT))
        passed = scored.filter((F.col("support") >= MIN_SEEDS) & (F.col("score") >= CONFIDENCE)).select("pattern", "of", "score")
        before, patterns = patterns, settle(passed)
        if before is None:
            moved = patterns
        else:
            old = before.withColumnRenamed("score", "old")
            moved = patterns.join(old, ["pattern", "of"], "left").filter(F.col("old").isNull() | (F.abs(F.col("score") - F.col("old")) > STILL))
        if moved.isEmpty():
            break
        believed = settle(unknown.join(patterns, "pattern").groupBy("value", "of").agg(F.max("score").alias("back")))
        more = unknown.join(believed, "value").groupBy("pattern", "n", "of").agg(F.count(F.lit(1)).alias("support"), F.sum("back").alias("good"))
        support = seeds.unionByName(more).groupBy("pattern", "n", "of").agg(*sums)
    return patterns


def private_spans(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the fixed patterns, base_sha256, spans and n_found of every row.

    Null and empty texts have no spans. Repeated rows are found one by one and count once in the statistics, which are over
    distinct words. Other columns are not read; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = settle(rows.mapInArrow(_find, _FOUND).withColumn("row", F.monotonically_increasing_id()))
    some = found.filter(F.size("unseen") > 0).select("row", F.explode("unseen").alias("c"))
    edges = some.select(F.explode("c.patterns").alias("pattern"), F.col("c.value").alias("value"), F.col("c.kind").alias("kind")).distinct()
    trusted = good_patterns(edges)

    unseen = some.filter("c.kind < 0").select("row", "c.start", "c.end", F.explode("c.patterns").alias("pattern")).join(trusted, "pattern")
    best = unseen.groupBy("row", "start", "end").agg(F.max_by("of", F.struct("score", -F.col("of"))).alias("of"))
    names = F.array(*[F.lit(k) for k in KINDS])
    # Of overlapping spans the first and longest stays.
    every = F.sort_array(F.collect_list(F.struct("start", (-F.col("end")).alias("back"), "of")))
    span = "struct<start:bigint,of:int,end:bigint>"
    apart = F.aggregate(
        every, F.array().cast(f"array<{span}>"),
        lambda out, s: F.when(
            s["start"] >= F.coalesce(F.try_element_at(out, F.lit(-1))["end"], F.lit(0)),
            F.concat(out, F.array(F.struct(s["start"].alias("start"), s["of"].alias("of"), (-s["back"]).alias("end")).cast(span))),
        ).otherwise(out),
    )
    extra = best.groupBy("row").agg(apart.alias("extra"))
    both = found.drop("unseen").join(extra, "row", "left")
    parsed = F.transform(
        F.filter(F.split("base", ","), lambda s: s != ""),
        lambda s: F.struct(
            F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("start"),
            (F.array_position(names, F.split_part(s, F.lit(":"), F.lit(1))) - 1).cast("int").alias("of"),
            F.split_part(s, F.lit(":"), F.lit(3)).cast("long").alias("end"),
        ),
    )
    merged = F.array_sort(F.concat(parsed, "extra"))
    text = F.array_join(F.transform(merged, lambda s: F.concat_ws(":", names[s["of"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return both.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
        F.when(F.col("extra").isNull(), F.col("base")).otherwise(text).alias("spans"),
        F.coalesce(F.size("extra"), F.lit(0)).cast("long").alias("n_found"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return private_spans(table(spark, sf_dir, "documents", "doc_id", "text"))
