"""Personal data: fixed patterns as seeds, and contexts learned from them.

Seeds are e-mail addresses, IPv4 addresses, payment card numbers and international phone numbers
found by pattern and test.  Around them the corpus is bootstrapped:

* Every seed is an instance.  So is every blank-delimited token with five digits or more, or with an at sign,
  and every run of two to twelve groups of digits or capitals ('017 555 7713', a spaced IBAN) with as many,
  unless it overlaps a seed.  The words of the text around an instance are its lexical patterns: two to the
  left, one on either side, one to the left.  A word of digits alone counts as 0.
* Patterns and instances form a graph over the whole corpus.  In each round a pattern's confidence is the
  smoothed mean of its instances' scores, and an instance's score is the chance that one of its
  patterns is right (1 for seeds).  A pattern lends its confidence only while enough of its instances
  have a high score, so instances found in one round support further patterns in the next.
* Patterns that end with a high confidence and enough such instances mark their other instances as
  identifiers, kind ``id``.

Rounds go on until one changes nothing in which patterns are trusted.  Identifiers of fewer than five digits without
an at sign are no candidates.  Only DataFrame operations are used.  The graph is aggregated before every join, so a frequent
pattern is one row per distinct instance; its rows are joined by sort and merge, which splits a pattern with very many.  Texts of any
length are read whole: running totals go in blocks, and overlaps are found in one pass over both kinds of spans in order.  Spans that
start together are ordered by kind.  Null texts count as empty.  Repeated rows get equal spans.  An empty
table gives an empty result; further columns do not matter.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

KINDS = ("email", "ip", "card", "phone", "id")
_BLANK = "\\x20\\x09-\\x0D"
#: The last repetition of each is possessive: nothing follows it, so the matches are the same, and long ones need no stack.
_EMAIL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)++"
_IP = "[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+"
_CARD = "[0-9](?:[\\x20-]?[0-9])++"
_PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
_TOKEN = f"[^{_BLANK}0-9@]*+[0-9@][^{_BLANK}]*+"
#: Groups of a run: digits with capitals or signs, one group of capitals alone between two of them.
_GROUP = "[+(]{0,2}[A-Z]{0,4}[0-9][0-9A-Z()./-]*+(?!\\p{L})"
_RUN = f"(?<![^{_BLANK}]){_GROUP}(?:\\x20(?:[A-Z]{{1,4}}\\x20)?{_GROUP}){{1,11}}+"
MIN_DIGITS = 5
#: Rounds at least; more follow as long as a round changes which patterns are trusted.
ROUNDS = 3
#: What a pattern needs: confidence, different instances, different instances that score as much.
CONFIDENCE, MIN_INSTANCES, MIN_SEEDS = 0.7, 4, 3
#: Code points of the text to either side in which an instance's words are sought; of a longer word the nearer part counts.
REACH = 1000
#: Elements that a running total takes together.
_BLOCK = 256
_SPAN = "start: int, kind: int, end: int, bstart: int, bend: int"


def _none(kind: str) -> Column:
    return F.from_json(F.lit("[]"), f"array<{kind}>")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(values: Column, join) -> Column:
    """For each of an array of whole numbers, what ``join`` makes of 0 and all before it.

    In blocks, so that a long array is not copied for every element: first within each block, then over the blocks.
    """
    start = F.struct(F.lit(0).alias("at"), _none("int").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        return F.struct(join(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def over(parts: Column) -> Column:
        bases = F.aggregate(parts, start, lambda acc, p: step(acc, p["at"]), lambda acc: acc["out"])
        return F.flatten(F.zip_with(parts, bases, lambda p, base: F.transform(p["out"], lambda x: join(base, x))))

    def blocks(xs: Column) -> Column:
        last = F.floor((F.size(xs) - 1) / _BLOCK).cast("int")
        parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(xs, i * _BLOCK + 1, F.lit(_BLOCK)))
        return _let(F.transform(parts, lambda part: F.aggregate(part, start, step)), over)

    return _let(values, lambda xs: F.when(F.size(xs) > 0, blocks(xs)).otherwise(_none("int")))


def _plus(a: Column, b: Column) -> Column:
    return a + b


def _hits(text: Column, pattern: str, good) -> Column:
    """array<struct<start, end, bstart, bend, s, before, after>> of the leftmost non-overlapping matches that are ``good``.

    Starts and ends are in code points and in bytes; before and after are the text's next ``REACH`` code points.
    """

    def both(size):
        return lambda b, s: size(b) + size(s)

    def rows(x: Column) -> Column:
        found, between = x["found"], x["between"]
        n = F.size(found)

        def later(parts: Column, by: int) -> Column:
            return F.slice(parts, F.lit(by + 1), n)

        def earlier(parts: Column, by: int) -> Column:
            return F.slice(F.concat(F.array_repeat(F.lit(""), by), parts), F.lit(1), n)

        at, bat = (_before(F.zip_with(later(between, 0), found, both(size)), _plus) for size in (F.length, F.octet_length))
        names = {"at": at, "bat": bat, "b0": later(between, 0), "s": found}
        names |= {f"b{i}": earlier(between, i) for i in (1, 2, 3)} | {f"f{i}": earlier(found, i) for i in (1, 2, 3)}
        names |= {f"a{i}": later(between, i) for i in (1, 2)} | {f"g{i}": later(found, i) for i in (1, 2)}
        return F.arrays_zip(*(c.alias(k) for k, c in names.items()))

    def row(x: Column) -> Column:
        start, bstart = x["at"] + F.length(x["b0"]), x["bat"] + F.octet_length(x["b0"])
        before = F.concat(*(F.substring(x[c], -REACH, REACH) for c in ("b3", "f3", "b2", "f2", "b1", "f1", "b0")))
        after = F.concat(*(F.substring(F.coalesce(x[c], F.lit("")), 1, REACH) for c in ("a1", "g1", "a2", "g2")))
        return F.struct(
            start.alias("start"),
            (start + F.length(x["s"])).alias("end"),
            bstart.alias("bstart"),
            (bstart + F.octet_length(x["s"])).alias("bend"),
            x["s"].alias("s"),
            F.substring(before, -REACH, REACH).alias("before"),
            F.substring(after, 1, REACH).alias("after"),
        )

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))
    return F.transform(F.filter(_let(parts, rows), lambda x: good(x["s"])), row)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    d = _digits(s)

    def add(acc: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + x - F.when(x > 9, 9).otherwise(0)

    fits = F.length(d).between(12, 19)
    return fits & F.when(fits, F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), add) % 10 == 0).otherwise(False)


def _octets(s: Column) -> Column:
    return F.forall(F.split(s, "\\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))


def _as_span(kind: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), *(x[c].alias(c) for c in ("end", "bstart", "bend", "s", "before", "after")))


def _of_kind(kind: int):
    return lambda x: x["kind"] == kind


def _seeds(text: Column) -> Column:
    """array<struct<start, kind, end, bstart, bend, s, before, after>> of the seeds, by start, then kind."""
    digit = text.rlike("[0-9]")
    tests = (
        (text.contains("@"), _EMAIL, lambda s: F.lit(True)),
        (digit & text.contains("."), _IP, _octets),
        (digit, _CARD, _luhn),
        (digit & text.contains("+"), _PHONE, lambda s: F.length(_digits(s)).between(9, 15)),
    )
    parts = []
    for kind, (gate, pattern, good) in enumerate(tests):
        kept = F.transform(_hits(text, pattern, good), _as_span(kind))
        parts.append(F.when(gate, kept).otherwise(_none(f"struct<{_SPAN}, s: string, before: string, after: string>")))
    return F.array_sort(F.concat(*parts))


def _apart(items: Column, seeds: Column) -> Column:
    """The ``items`` (disjoint, by start) that overlap none of the ``seeds`` (by start): one pass over both in order."""
    far = F.lit(2**31 - 1)

    def compared(both: Column) -> Column:
        ends = _before(F.transform(both, lambda x: F.when(x["item"] == 0, x["end"]).otherwise(0)), F.greatest)
        # back to front: how far before the largest number the next seed starts
        starts = F.reverse(_before(F.reverse(F.transform(both, lambda x: F.when(x["item"] == 0, far - x["start"]).otherwise(0))), F.greatest))
        free = F.arrays_zip(both.alias("x"), ends.alias("before"), starts.alias("after"))
        return F.transform(F.filter(free, lambda f: f["x"]["item"] == 1), lambda f: (f["before"] <= f["x"]["start"]) & (far - f["after"] >= f["x"]["end"]))

    def marked(which: int):
        return lambda x: F.struct(x["start"].alias("start"), F.lit(which).alias("item"), x["end"].alias("end"))

    def kept(own: Column) -> Column:
        free = _let(F.array_sort(F.concat(F.transform(seeds, marked(0)), F.transform(own, marked(1)))), compared)
        both = F.arrays_zip(own.alias("x"), free.alias("free"))
        return F.when((F.size(seeds) == 0) | (F.size(own) == 0), own).otherwise(F.transform(F.filter(both, lambda b: b["free"]), lambda b: b["x"]))

    return _let(items, kept)


def _instances(text: Column, seeds: Column) -> Column:
    """array<struct<start, end, bstart, bend, s, seed, patterns>> of the seeds and the identifier-like tokens and runs besides them."""
    edge = "^[^\\p{L}\\p{N}@+]+|[^\\p{L}\\p{N}]+$"

    def word(found: Column) -> Column:
        letters = F.lower(F.regexp_replace(found, "[^\\p{L}=:#]+", ""))
        return F.when((letters == "") & found.rlike("[0-9]"), "0").otherwise(letters)

    def patterns(x: Column) -> Column:
        # words to the left are sought from the end: anchored patterns on reversed text take no more steps than they need
        back = F.reverse(x["before"])
        left1 = word(F.reverse(F.regexp_extract(back, f"^[^{_BLANK}]*+[{_BLANK}]++([^{_BLANK}]++)", 1)))
        left2 = word(F.reverse(F.regexp_extract(back, f"^[^{_BLANK}]*+[{_BLANK}]++[^{_BLANK}]++[{_BLANK}]++([^{_BLANK}]++)", 1)))
        right = word(F.regexp_extract(x["after"], f"^[^{_BLANK}]*+[{_BLANK}]++([^{_BLANK}]++)", 1))

        def named(words: Column) -> Column:
            l1, l2, r = words["l1"], words["l2"], words["r"]
            return F.array_compact(F.array(
                F.when((l1 != "") & (l2 != ""), F.concat(F.lit("2 "), l2, F.lit(" "), l1)),
                F.when((l1 != "") & (r != ""), F.concat(F.lit("r "), l1, F.lit(" _ "), r)),
                F.when(l1 != "", F.concat(F.lit("1 "), l1)),
            ))

        return _let(F.struct(left1.alias("l1"), left2.alias("l2"), right.alias("r")), named)

    def instance(x: Column, start: Column, bstart: Column, s: Column, seed: bool) -> Column:
        return F.struct(start.alias("start"), (start + F.length(s)).alias("end"), bstart.alias("bstart"), (bstart + F.octet_length(s)).alias("bend"), s.alias("s"), F.lit(seed).alias("seed"), patterns(x).alias("patterns"))

    def one(x: Column) -> Column:
        core = F.regexp_replace(x["s"], edge, "")
        lead = F.regexp_extract(x["s"], "^([^\\p{L}\\p{N}@+]*)", 1)
        return instance(x, x["start"] + F.length(lead), x["bstart"] + F.octet_length(lead), core, False)

    def known(x: Column) -> Column:
        return instance(x, x["start"], x["bstart"], x["s"], True)

    def likely(s: Column) -> Column:
        return (F.length(_digits(s)) >= MIN_DIGITS) | s.contains("@")

    none = _none("struct<start: int, end: int, bstart: int, bend: int, s: string, seed: boolean, patterns: array<string>>")
    tokens = F.when(text.rlike("[0-9@]"), F.transform(_apart(_hits(text, _TOKEN, likely), seeds), one)).otherwise(none)
    runs = F.when(text.rlike("[0-9][^\\x20]*\\x20"), F.transform(_apart(_hits(text, _RUN, likely), seeds), one)).otherwise(none)
    return F.concat(F.transform(seeds, known), tokens, runs)


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS, confidence: float = CONFIDENCE, min_instances: int = MIN_INSTANCES, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """(pattern, score) of the trusted patterns of a graph (pattern, s, seed)."""
    wide = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_instances)
    edges = settle(edges.join(wide.select("pattern"), "pattern"), "graph")
    scores = edges.groupBy("s").agg(F.max("seed").cast("double").alias("score"))
    patterns, before, turn = None, None, 0
    supported = F.col("support") >= min_seeds
    trusted = (F.col("score") >= confidence) & supported
    while True:
        turn += 1
        support = F.sum((F.col("score") >= confidence).cast("int")).alias("support")
        patterns = settle(edges.join(scores, "s").groupBy("pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("score"), support), "patterns", instead_of=(patterns,) if patterns is not None else ())
        # scores only ever rise, so these counts do too, and end
        now = patterns.agg(F.count_if(trusted), F.count_if(supported), F.sum("support")).first()
        if turn >= rounds and now == before:
            return patterns.where(trusted).select("pattern", "score")
        before = now
        missed = F.sum(F.when(supported, F.log1p(-F.least(F.col("score"), F.lit(0.99)))).otherwise(0.0))
        scores = settle(edges.join(patterns, "pattern").groupBy("s").agg(F.greatest(F.max("seed").cast("double"), 1 - F.exp(missed)).alias("score")), "scores", instead_of=(scores,) if turn > 1 else ())


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple = ()) -> DataFrame:
    """(row, id, base, spans, cuts) of every row, and the ``carry`` columns; spans are array<struct<start, kind, end>>.

    ``cuts`` are the spans with their places in the text's bytes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text.alias("t"), *carry)
    rows = rows.withColumn("seeds", _seeds(F.col("t"))).withColumn("found", _instances(F.col("t"), F.col("seeds")))
    rows = rows.withColumn("own", F.transform("seeds", lambda x: F.struct(*(x[c].alias(c) for c in ("start", "kind", "end", "bstart", "bend")))))
    rows = settle(rows.drop("t", "seeds"), "instances")
    places = rows.where("size(found) > 0").select("row", F.explode("found").alias("x")).select("row", "x.*")
    edges = places.select(F.explode("patterns").alias("pattern"), "s", "seed").groupBy("pattern", "s").agg(F.max("seed").alias("seed"))
    trusted = confident_patterns(edges)
    span = F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end", "bstart", "bend")
    fresh = places.where("not seed and end > start").select("row", span.alias("span"), F.explode("patterns").alias("pattern")).join(trusted, "pattern")
    fresh = settle(fresh.groupBy("row").agg(F.collect_set("span").alias("more")), "fresh")  # its size is known then, and the join is planned by it
    out = rows.drop("found").join(fresh, "row", "left")
    cuts = F.when(F.col("more").isNull(), F.col("own")).otherwise(F.array_sort(F.concat("own", "more")))
    out = out.select("row", F.col("id").alias(id_col), *carry, "own", cuts.alias("cuts"))
    plain = lambda c: F.transform(c, lambda x: F.struct(*(x[k].alias(k) for k in ("start", "kind", "end"))))
    return out.select("row", id_col, *carry, plain("own").alias("base"), plain("cuts").alias("spans"), "cuts")


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat(F.element_at(names, x["kind"] + 1), F.lit(":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    counts = [F.size(F.filter("base", _of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return found.select(id_col, *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def masked(text: Column, cuts: Column) -> Column:
    """``text`` with each cut (by start), or run of overlapping cuts, replaced by its kind in angle brackets."""
    names = F.array(*(F.lit(f"<{k}>") for k in KINDS))

    def put_together(x: Column) -> Column:
        raw, spans, upto = x["raw"], x["spans"], x["upto"]

        def piece(c: Column) -> Column:
            plain = F.substring(raw, c["upto"] + 1, c["x"]["bstart"] - c["upto"]).cast("string")
            return F.when(c["x"]["bstart"] >= c["upto"], F.concat(plain, F.element_at(names, c["x"]["kind"] + 1))).otherwise("")

        last = F.greatest(F.element_at(upto, -1), F.element_at(spans, -1)["bend"])
        pieces = F.transform(F.arrays_zip(spans.alias("x"), upto.alias("upto")), piece)
        return F.concat(F.array_join(pieces, ""), F.substring(raw, last + 1, F.octet_length(raw)).cast("string"))

    # bytes, as a place among them is found at once
    upto = _before(F.transform(cuts, lambda c: c["bend"]), F.greatest)
    return F.when(F.size(cuts) > 0, _let(F.struct(text.cast("binary").alias("raw"), cuts.alias("spans"), upto.alias("upto")), put_together)).otherwise(text)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in the texts, and ``size_col`` of these set anew where there is one."""
    rest = tuple(c for c in docs.columns if c not in (id_col, text_col))
    names = {c: f"c_{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    found = find(plain, names[id_col], names[text_col], tuple(names[c] for c in rest) + (names[text_col],))
    text = F.when(F.size("spans") > 0, masked(F.col(names[text_col]), F.col("cuts"))).otherwise(F.col(names[text_col]))
    found = found.withColumn("masked", text)
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("masked").alias(c))
        elif c == size_col:
            columns.append(F.when(F.size("spans") > 0, F.length("masked").cast(docs.schema[c].dataType)).otherwise(F.col(names[c])).alias(c))
        else:
            columns.append(F.col(names[c]).alias(c))
    return found.select(*columns)
