"""PII: patterns for direct identifiers, and information-theoretic sanitisation of what reveals them.

Direct identifiers (emails, IPv4 addresses, card and phone numbers) are found by pattern. A
word that stands with an identifier can still reveal it once the identifier is masked, when
the word is rarely seen without it. The corpus tells: with n(t, e) documents that have both
term t and entity e, n(t) documents that have t and N documents,

    p(e | t) = n(t, e) / n(t)          I(t; e) = log2(n(t, e) * N / (n(t) * n(e)))

and t discloses e when both reach their thresholds and chance does not explain it:
were e spread over the documents at random, at least n(t, e) of the n(t) would hold it with a
probability of at most 2 ** -S, with q = n(e) / N, p = p(e | t) and

    S = n(t, e) * (I + (1 - p) / p * log2((1 - p) / (1 - q)))

(the Chernoff bound). Copies of one text are one support: S counts different texts for n(t, e).
One text is enough for an identifier that stands in few documents of many. Such a term
is generalised to the shape of its letters where it holds upper case, else removed, wherever it
stands, in documents without the identifier too. Letters of identifiers are no terms.

Everything is DataFrame expressions. Positions are code points, ends exclusive.

Cases: a null text is the empty text; rows that share a ``doc_id`` are kept apart; a null
``doc_id`` stays null; identical rows get identical spans; an empty table gives an empty
result; other columns pass through ``sanitised`` untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, set_aside, table

# The kinds and their patterns. Repetitions that nothing can follow are
# possessive, and a run is tried from its start only: the same matches, in linear time.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
KINDS = ("email", "ip", "card", "phone")

#: A term is a run of at least this many letters.
TERM = r"\p{L}{4,}"
#: Disclosure thresholds: p(e | t), I(t; e) in bits, and S in bits (a chance of one in 256).
MIN_P, MIN_BITS, MIN_SURE = 0.5, 6.0, 8.0
#: Code points of a chunk of a text that is rewritten.
CHUNK = 1024
#: Most words of 64 bits in a bit map: more values than fit make it let more rows pass, never fewer.
WORDS = 1 << 20

_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _running(values: Column, both: Callable[[Column, Column], Column]) -> Column:
    """Running sums or maxima of an array, by doubling steps: n log n, where growing an array is quadratic."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(2)))).cast("int") - 1)

    def twice(acc: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda x, i: F.when(i >= back, both(x, F.get(acc, i - back))).otherwise(x))

    return F.aggregate(rounds, values, twice)


def _ends(values: Column, pieces: Column) -> Column:
    """Where the matches ``values`` end, from the pieces between them."""
    sizes = F.transform(values, lambda v, i: F.char_length(v) + F.char_length(F.get(pieces, i)))
    return _running(sizes, lambda x, y: x + y)


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches with their places, from the pieces between them."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("v"), F.split(text, pattern, -1).alias("p"))

    def placed(m: Column) -> Column:
        def with_ends(ends: Column) -> Column:
            return F.transform(m["v"], lambda v, i: F.struct(F.lit(kind).alias("kind"), (F.get(ends, i) - F.char_length(v)).alias("start"), F.get(ends, i).alias("end"), v.alias("value")))

        return F.when(F.size(m["v"]) == 0, F.array().cast(f"array<{_SPAN}>")).otherwise(_bound(_ends(m["v"], m["p"]), with_ends))

    return _bound(found, placed)


def _cut(chunks: Column, lo: Column, hi: Column) -> Column:
    """Code points ``lo`` to ``hi`` of a text given as chunks of ``CHUNK``: a place in a long text costs no scan from its start."""

    def part(k: Column) -> Column:
        at = F.greatest(lo - k * CHUNK, F.lit(0))
        return F.substring(F.get(chunks, k), at + 1, F.least(hi - k * CHUNK, F.lit(CHUNK)) - at)

    between = F.sequence(F.floor(lo / CHUNK).cast("int"), F.floor((hi - 1) / CHUNK).cast("int"))
    return F.when(hi <= lo, F.lit("")).otherwise(F.array_join(F.transform(between, part), ""))


def _rewritten(text: Column, spans: Column, mark: Callable[[Column, Column, Column], Column]) -> Column:
    """The text with each span replaced by ``mark(span, its text, the end of all before it)``.

    Spans go by start, the longest first; what overlaps one before it is not in the text any more.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("rev"), s["kind"].alias("kind"))))
    parts = F.struct(ordered.alias("s"), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("c"))

    def run(p: Column) -> Column:
        def pieces(tops: Column) -> Column:
            def piece(s: Column, i: Column) -> Column:
                before = F.coalesce(F.get(tops, i - 1), F.lit(0))
                word = _cut(p["c"], s["start"], -s["rev"])
                return F.concat(_cut(p["c"], before, s["start"]), mark(s, word, before))

            return F.concat(F.array_join(F.transform(p["s"], piece), ""), _cut(p["c"], F.element_at(tops, -1), F.char_length(text)))

        return _bound(_running(F.transform(p["s"], lambda s: -s["rev"]), lambda x, y: F.greatest(x, y)), pieces)

    return F.when(text.isNull() | (F.size(spans) == 0), text).otherwise(_bound(parts, run))


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def term(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), term), F.lit(0), lambda a, b: a + b) % 10 == 0


def base_spans(text: Column) -> Column:
    """Direct identifiers as an array of ``kind, start, end, value``, by kind and then start."""
    empty = F.array().cast(f"array<{_SPAN}>")
    digit = text.rlike("[0-9]")

    def digits(s: Column) -> Column:
        return F.regexp_replace(s["value"], "[^0-9]", "")

    email = F.when(F.contains(text, F.lit("@")), _spans(text, EMAIL, "email")).otherwise(empty)
    ip = F.filter(F.when(digit, _spans(text, IP, "ip")).otherwise(empty), lambda s: s["value"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    card = F.filter(
        F.when(digit & text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), _spans(text, CARD, "card")).otherwise(empty),
        lambda s: F.when(F.char_length(digits(s)).between(16, 19), _luhn(digits(s))).otherwise(False),
    )
    phone = F.filter(F.when(digit & F.contains(text, F.lit("+")), _spans(text, PHONE, "phone")).otherwise(empty), lambda s: F.char_length(digits(s)).between(8, 15))
    return F.concat(email, ip, card, phone)


def _entity(s: Column) -> Column:
    """What makes two identifiers the same one: letters' case and separators of digits don't."""
    plain = F.when(s["kind"].isin("card", "phone"), F.regexp_replace(s["value"], "[^0-9]", "")).otherwise(F.lower(s["value"]))
    return F.concat(s["kind"], F.lit(":"), plain)


def _free(text: Column, base: Column) -> Column:
    """The text with blanks for the code points of its identifiers."""
    return _rewritten(text, base, lambda s, word, before: F.repeat(F.lit(" "), -s["rev"] - F.greatest(s["start"], before)))


def _terms(free: Column) -> Column:
    return F.transform(F.regexp_extract_all(free, F.lit(TERM), F.lit(0)), F.lower)


def _places(free: Column, wanted: Column) -> Column:
    """Spans of the terms whose numbers in the text are in ``wanted``."""
    found = F.struct(F.regexp_extract_all(free, F.lit(TERM), F.lit(0)).alias("v"), F.split(free, TERM, -1).alias("p"), wanted.alias("w"))

    def placed(t: Column) -> Column:
        def with_ends(ends: Column) -> Column:
            def span(i: Column) -> Column:
                return F.struct(F.lit("term").alias("kind"), (F.get(ends, i) - F.char_length(F.get(t["v"], i))).alias("start"), F.get(ends, i).alias("end"), F.lit(None).cast("string").alias("value"))

            return F.transform(t["w"], span)

        return _bound(_ends(t["v"], t["p"]), with_ends)

    return _bound(found, placed)


class _Marks:
    """A bit map of the values of ``wanted.column``, to tell rows apart before they are shuffled."""

    def __init__(self, wanted: DataFrame, column: str) -> None:
        self.words = 1 << min(WORDS.bit_length() - 1, max(10, wanted.count().bit_length()))
        word, bit = self._spot(column)
        self.maps = saved(wanted.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits")), "pii-marks")

    def _spot(self, column: str) -> tuple[Column, Column]:
        spot = F.xxhash64(column)
        return F.shiftright(spot, 6).bitwiseAND(F.lit(self.words - 1)), spot.bitwiseAND(F.lit(63)).cast("int")

    def rows(self, rows: DataFrame, column: str, there: bool = True) -> DataFrame:
        """The rows that may be wanted, or those that are certainly not."""
        word, bit = self._spot(column)
        # At most WORDS rows, whatever the input.
        return rows.join(F.broadcast(self.maps), (word == F.col("_word")) & (F.getbit("_bits", bit) == 1), "left_semi" if there else "left_anti")


def _discloses(n_docs: int) -> Column:
    """Whether a pair with ``n_te, texts, n_t, n_e`` is over the thresholds."""
    p, q = F.col("n_te") / F.col("n_t"), F.col("n_e") / F.lit(float(n_docs))
    bits = F.log2(p / q)
    others = F.when((p < 1) & (q < 1), (1 - p) / p * F.log2((1 - p) / (1 - q))).otherwise(0.0)
    return (p >= MIN_P) & (bits >= MIN_BITS) & (F.col("texts") * (bits + others) >= MIN_SURE)


def disclosed(rows: DataFrame, n_docs: int) -> DataFrame:
    """``term``: those that are over the thresholds with some entity.

    ``rows``: all documents, with ``row``, ``text_key``, ``free`` text and ``entities``. Entities
    that stand in the same documents have the same counts with every term, so they are counted as
    one class: a document of very many identifiers makes few pairs. Classes too rare for a term's
    least share, or too common for the least information, are left out before pairs are made.
    Pairs are counted per text first, so copies shrink before the shuffle.
    """
    private = F.size("entities") > 0
    # All terms are counted, map-side first. No entity can have a larger share of a term's
    # documents than all of them together, so most terms never make pairs.
    words = rows.select(private.cast("long").alias("private"), F.explode(F.array_distinct(_terms(F.col("free")))).alias("term"))
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t"), F.sum("private").alias("n_p"))
    counts = saved(counts.filter((F.col("n_p") > 0) & (F.col("n_p") / F.col("n_t") >= MIN_P)).select("term", "n_t"), "pii-counts")
    known = rows.filter(private)
    entities = known.select("row", F.explode("entities").alias("entity"))
    held = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), F.bit_xor(F.xxhash64("row")).alias("s"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("t"))
    classes = entities.join(held.select("entity", "n_e", F.xxhash64("s", "t").alias("class")), "entity").filter(F.col("n_e") * 2**MIN_BITS <= n_docs).select("row", "class", "n_e").distinct()
    told = known.select("row", "text_key", F.explode(F.array_distinct(_terms(F.col("free")))).alias("term"))
    told = _Marks(counts, "term").rows(told, "term").join(counts, "term")
    pairs = told.join(classes, "row").filter(F.col("n_e") >= F.col("n_t") * MIN_P)
    by_text = pairs.groupBy("class", "n_e", "term", "text_key").agg(F.count(F.lit(1)).alias("n"), F.first("n_t").alias("n_t"))
    found = by_text.groupBy("class", "n_e", "term").agg(F.sum("n").alias("n_te"), F.count(F.lit(1)).alias("texts"), F.first("n_t").alias("n_t"))
    return saved(found.filter(_discloses(n_docs)).select("term").distinct(), "pii-terms")


def sanitised(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those to ``keep``) and ``pii_base``, ``pii_spans`` (arrays of spans).

    ``pii_spans`` holds the base spans and a span of kind ``term`` for each place of a disclosed term.
    Columns of these two names in ``docs`` are replaced.
    """
    docs, back = set_aside(docs.drop("pii_base", "pii_spans"), ("_pii_row", "_pii_at"))
    known = docs.columns if keep is None else keep
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumn("_pii_row", F.monotonically_increasing_id()).withColumn("pii_base", base_spans(text))
    # The row numbers hold only once they are written.
    rows = saved(rows.select(*dict.fromkeys([*known, "text"]), "pii_base", "_pii_row"), "pii-base")
    free = _free(text, F.col("pii_base")).alias("free")
    entities = F.array_distinct(F.transform("pii_base", _entity)).alias("entities")
    terms = disclosed(rows.select(F.col("_pii_row").alias("row"), F.xxhash64(text).alias("text_key"), free, entities), rows.count())
    tokens = rows.select("_pii_row", F.posexplode(_terms(free)).alias("at", "term"))
    hits = _Marks(terms, "term").rows(tokens, "term").join(terms, "term", "left_semi")
    hits = saved(hits.groupBy("_pii_row").agg(F.array_sort(F.collect_list("at")).alias("_pii_at")), "pii-hits")  # of one document
    marks = _Marks(hits, "_pii_row")
    # Only texts that hold terms are shuffled, by the same join at any size.
    found = marks.rows(rows, "_pii_row").join(hits.hint("merge"), "_pii_row", "left")
    spans = F.when(F.col("_pii_at").isNull(), F.col("pii_base")).otherwise(F.concat("pii_base", _places(free, F.col("_pii_at"))))
    plain = marks.rows(rows, "_pii_row", there=False).withColumn("pii_spans", F.col("pii_base"))
    return back(found.withColumn("pii_spans", spans).select(*known, "pii_base", "pii_spans").unionByName(plain.select(*known, "pii_base", "pii_spans")))


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans generalised or removed; overlapping spans make one mark."""

    def mark(s: Column, word: Column, before: Column) -> Column:
        shape = F.regexp_replace(F.regexp_replace(word, r"\p{Lu}", "X"), r"\p{Ll}", "x")
        shown = F.when(s["kind"] != "term", F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).when(word.rlike(r"\p{Lu}"), shape).otherwise(F.lit(""))
        return F.when(s["start"] >= before, shown).otherwise(F.lit(""))

    return _rewritten(text, spans, mark)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sanitised(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("pii_base")), 256).alias("base_sha256"), _joined(F.col("pii_spans")).alias("spans"))
