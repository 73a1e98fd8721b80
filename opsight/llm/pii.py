"""Personal data: base patterns, and identifiers found through the contexts that known ones stand in.

Columns and SQL functions only; positions are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsight.session import cut_lineage, scratch_path

# What a match of each kind looks like. Starts inside a run that can't match are left out by
# looking back, and loops don't give back, which changes no match and keeps long runs linear.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ["email", "ip", "card", "phone"]
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: A word, of ASCII white space between, with a digit or an at sign: what may be an identifier.
WORD = r"(?:(?<![^\x20\x09-\x0D])|\G)[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: A pattern counts once so many different known identifiers stand in it, and such a share of all does.
SUPPORT, CONFIDENCE = 3, 0.9
#: Scores are whole thousandths, rounded down, so they can rise a bounded number of times only.
SCALE = 1000
#: The first and the last word of a text.
FIRST = r"^[\x20\x09-\x0D]*+([^\x20\x09-\x0D]++)"
LAST = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]*+$"


#: Matches of a text that are placed together.
BLOCK = 256


def _named(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _found(text: Column, pattern: str, hint: str) -> Column:
    """All matches as (start, end, value); ``hint`` is a cheap pattern that every text with a match has."""
    values = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    # the text before match i is the gaps up to i and the matches before it; the text is split once, as an argument
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
    steps = F.zip_with(values, gaps, lambda v, gap: F.struct(
        F.length(gap).alias("gap"), F.length(v).alias("width"), v.alias("value")))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def placed(block: Column, at: Column) -> Column:
        return F.aggregate(
            block, F.struct(at.alias("at"), empty.alias("made")),
            lambda acc, s: F.struct(
                (acc["at"] + s["gap"] + s["width"]).alias("at"),
                F.concat(acc["made"], F.array(F.struct(
                    (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["width"]).alias("end"),
                    s["value"].alias("value")))).alias("made")),
            lambda acc: acc["made"],
        )

    def by_block(blocks: Column) -> Column:
        begins = F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins")),
            lambda acc, block: F.struct(
                F.aggregate(block, acc["at"], lambda at, s: at + s["gap"] + s["width"]).alias("at"),
                F.concat(acc["begins"], F.array(acc["at"])).alias("begins")),
            lambda acc: acc["begins"],
        )
        return F.flatten(F.zip_with(blocks, begins, placed))

    # an array grows by copies, so blocks of a bounded size are placed on their own
    blocks = _named(steps, lambda s: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(s) - 1) / BLOCK).cast("int")), lambda b: F.slice(s, F.greatest(b, F.lit(0)) * BLOCK + 1, BLOCK)))
    folded = _named(blocks, by_block)
    return F.when(text.rlike(hint), folded).otherwise(empty)


def _luhn(digits: Column) -> Column:
    turned = F.split(F.reverse(digits), "")
    doubled = F.transform(turned, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.expr("0") + 2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def base_spans(text: Column) -> Column:
    """The base matches that pass their test, as (start, kind number, end), by start and then kind."""
    cards = F.filter(_found(text, CARD, "[0-9]"), lambda m: F.length(_digits(m["value"])).between(12, 19))
    kinds = [
        _found(text, EMAIL, "@"),
        F.filter(_found(text, IP, r"[0-9]\.[0-9]"), lambda m: m["value"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        F.filter(cards, lambda m: _luhn(_digits(m["value"]))),
        F.filter(_found(text, PHONE, r"\+[0-9]"), lambda m: F.length(_digits(m["value"])).between(9, 15)),
    ]

    def numbered(found: Column, n: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(n).alias("kind"),
                                                     m["end"].alias("end")))

    return F.array_sort(F.concat(*[numbered(found, n) for n, found in enumerate(kinds)]))


def spans_text(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _shape(word: Column) -> Column:
    """Runs of digits as one 0, runs of letters as one a; what separates them stays."""
    return F.regexp_replace(F.regexp_replace(word, "[0-9]+", "0"), r"\p{L}+", "a")


def candidates(text: Column) -> Column:
    """Words that may be identifiers, without the marks behind them, as (start, end, value, left, right).

    ``left`` and ``right`` are the words beside it in lower case, or their shape if they hold a digit, and
    empty at the ends of the text.
    """
    # matches are whole words, so a word beside one ends the gap before it or begins the gap behind it
    gaps = F.transform(F.split(text, WORD, -1), lambda gap: F.struct(
        F.regexp_extract(gap, FIRST, 1).alias("first"), F.regexp_extract(gap, LAST, 1).alias("last")))
    seen = F.struct(_found(text, WORD, "[0-9@]").alias("found"), gaps.alias("gaps"))

    def beside(word: Column, found: Column, n: Column) -> Column:
        near = F.when(word != "", word).otherwise(F.coalesce(F.get(found, n)["value"], F.lit("")))
        return F.when(near.rlike("[0-9]"), _shape(near)).otherwise(F.lower(near))

    def placed(s: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            value = F.regexp_replace(m["value"], "(?<![.,;:!?\"'])[.,;:!?\"']++$", "")
            return F.struct(
                m["start"].alias("start"), (m["start"] + F.length(value)).alias("end"), value.alias("value"),
                beside(F.get(s["gaps"], i)["last"], s["found"], i - 1).alias("left"),
                beside(F.get(s["gaps"], i + 1)["first"], s["found"], i + 1).alias("right"))

        return F.transform(s["found"], one)

    empty = F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>")
    return F.when(text.rlike("[0-9@]"), _named(seen, placed)).otherwise(empty)


def bootstrap(words: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """The instances that contexts show to be identifiers: instance, kind.

    ``words`` has a row per occurrence: instance (value), shape, left, right and kind (of the base span that
    it is part of, or null). A pattern is a shape with the word on its left, or on its right. Patterns and
    distinct instances make a graph: a pattern's confidence in a kind is the mean score of its instances,
    where known ones score 1 or 0; an unknown one's score is that of its best pattern, and patterns
    below the support and the confidence pass nothing on. Instances found in one round count as known, at their score, in
    all their patterns in the next, so they give rise to new patterns; rounds end when no score rises any more.
    Copies of a text add nothing, as edges are distinct.
    """
    sides = F.explode(F.array(F.struct(F.lit("L").alias("side"), F.col("left").alias("word")),
                              F.struct(F.lit("R").alias("side"), F.col("right").alias("word"))))
    edges = words.select("instance", "shape", "kind", sides.alias("s")).where("s.word != ''").groupBy(
        F.xxhash64("shape", "s.side", "s.word").alias("pattern"), "instance").agg(F.max("kind").alias("kind"))
    edges = cut_lineage(edges)
    # only patterns with instances enough can ever pass something on
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    live = cut_lineage(edges.join(sizes, "pattern"))
    base = live.where("kind IS NOT NULL").select("pattern", "kind", "n", F.lit(SCALE).cast("long").alias("score"))
    unknown = live.where("kind IS NULL").drop("kind")
    least = round(confidence * SCALE)
    score, before = None, (0, None)
    while True:
        known = base
        if score is not None:
            known = base.unionByName(unknown.join(score, "instance").select("pattern", "kind", "n", "score"))
        good = known.groupBy("pattern", "kind").agg(
            F.count("*").alias("seeds"), F.expr("sum(score) div max(n)").alias("trust")).where(
            (F.col("seeds") >= support) & (F.col("trust") >= least)).select("pattern", "kind", "trust")
        score = cut_lineage(unknown.join(good, "pattern").groupBy("instance", "kind").agg(F.max("trust").alias("score")))
        now = tuple(score.agg(F.count("*"), F.sum("score")).first())
        if now == before:  # scores never fall
            break
        before = now
    best = score.groupBy("instance").agg(F.max(F.struct("score", F.col("kind"))).alias("b"))
    return best.select("instance", F.col("b.kind").alias("kind"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = False) -> DataFrame:
    """Per row: id, base and all spans as (start, kind number, end), and with ``with_rows`` the row as ``doc``.

    The texts are read once; their spans and candidate words go to a table in the shared folder.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    path = scratch_path(spark, "identifiers")
    docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.struct(*docs.columns).alias("doc")).select(
        F.monotonically_increasing_id().alias("row"), "id", base_spans(F.col("text")).alias("base"),
        candidates(F.col("text")).alias("words"), *["doc"] * with_rows).write.parquet(path)
    rows = spark.read.parquet(path)
    words = spark.read.parquet(path).where(F.size("words") > 0).select("row", "base", F.explode("words").alias("w")).select(
        "row", "w.start", "w.end", F.col("w.value").alias("instance"), _shape(F.col("w.value")).alias("shape"),
        "w.left", "w.right",
        F.get(F.expr("filter(base, s -> s.start < w.end AND s.end > w.start)"), F.lit(0))["kind"].alias("kind"))
    found = bootstrap(words).withColumnRenamed("kind", "new_kind")
    # written, so that its size is known when the join is planned
    path = scratch_path(spark, "found-identifiers")
    words.where("kind IS NULL").join(found, "instance").groupBy("row").agg(F.collect_list(F.struct(
        "start", F.col("new_kind").alias("kind"), "end")).alias("more")).write.parquet(path)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.drop("words").join(spark.read.parquet(path), "row", "left").select(
        "id", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"), *["doc"] * with_rows)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the base counts by kind, base_sha256 and spans of every row.

    A null or empty text has no spans. Texts are read whole. Repeated rows and null ids give a row each; an
    empty table gives none; other columns are not looked at.
    """
    found = find(docs, id_col, text_col)
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = {n})")).cast("long").alias(f"n_{kind}")
              for n, kind in enumerate(KINDS)]
    return found.select(F.col("id").alias(id_col), *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, every span, base or found, replaced by its kind in brackets.

    Of overlapping spans the first, by start and kind, gives the name. A null text stays null.
    """
    found = find(docs, id_col, text_col, with_rows=True)
    text = F.col("doc").getField(text_col)
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    made = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("made")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.when(s["start"] < acc["at"], acc["made"]).otherwise(F.concat(
                acc["made"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                F.element_at(names, s["kind"] + 1))).alias("made"))),
        lambda acc: F.concat(acc["made"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    new = F.when(F.size("spans") == 0, text).otherwise(made)
    return found.select(*[(new if c == text_col else F.col("doc").getField(c)).alias(c) for c in docs.columns])
