"""Which names occur in which texts.

``instr(text, name) > 0`` as a join condition compares every text with every name. Here texts and names meet in an
equi-join on the hash of something short that both hold, the seed, and ``instr`` confirms. Texts and names are cut in front of
every character that is no letter or digit. The pieces of a name but its first and last are pieces of any text that holds
it, and so are two in a row. A name with fewer pieces uses minimizers: of every ``w`` neighbouring runs of ``k``
characters the one with the least hash. If it has ``k + w - 1`` characters it holds a whole such window wherever it
occurs, so each minimizer of the name is one of the text. Of all its seeds a name uses the one fewest names have,
so a prefix that all names share does not bring all names to one text.

All of it is built-in functions: a run's hash comes from those of its halves, and the least of a window from the least of
its halves, so an array is passed over as often as the logarithms of ``k`` and ``w`` say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Least name length: (k, w), with k a power of two and k + w - 1 equal to the length.
WINDOWS = {32: (16, 17), 16: (8, 9), 8: (4, 5), 4: (4, 1), 2: (2, 1), 1: (1, 1)}
#: The classes of names that have whole pieces, one or more.
PIECE, PIECES = 1000, 2000
_CUT = r"(?=[^\p{L}\p{N}])"


def _named(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _neighbours(runs: Column, by: int, combine) -> Column:
    """Each value of an array combined with the one ``by`` places on; the array gets that much shorter."""

    def shifted(a: Column) -> Column:
        rest = F.greatest(F.size(a) - by, F.lit(0))
        return F.zip_with(F.slice(a, F.lit(1), rest), F.slice(a, F.lit(by + 1), rest), combine)

    return _named(runs, shifted)


def _minimizers(text: str, least: int) -> Column:
    """The different minimizers for names of at least ``least`` characters; none in a shorter text."""
    k, w = WINDOWS[least]
    runs = F.transform(F.split(text, ""), lambda c: F.xxhash64(c))
    by = 1
    while by < k:
        runs, by = _neighbours(runs, by, lambda a, b: F.xxhash64(a, b)), 2 * by
    by = 1
    while 2 * by <= w:
        runs, by = _neighbours(runs, by, lambda a, b: F.least(a, b)), 2 * by
    if by < w:
        runs = _neighbours(runs, w - by, lambda a, b: F.least(a, b))
    return F.array_distinct(runs)


def _class_of(name: str) -> Column:
    """The kind of seed that a name uses: two pieces in a row, one, or the widest window that fits in it."""
    whole = F.size(F.split(name, _CUT)) - 2
    longest = F.when(whole >= 2, F.lit(PIECES)).when(whole == 1, F.lit(PIECE))
    for least in WINDOWS:
        longest = longest.when(F.char_length(name) >= least, F.lit(least))
    return longest


def _seeds(text: str, kind: int, whole: bool) -> Column:
    """The different seeds of one kind. A text's pieces all count; a name's first and last may go on outside it."""
    if kind not in (PIECE, PIECES):
        return _minimizers(text, kind)
    pieces = F.split(text, _CUT)
    if not whole:
        pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 2, F.lit(0)))
    runs = F.transform(pieces, lambda p: F.xxhash64(p))
    return F.array_distinct(_neighbours(runs, 1, lambda a, b: F.xxhash64(a, b)) if kind == PIECES else runs)


def contains_pairs(texts: DataFrame, text_keys: list[str], text: str, names: DataFrame, name: str) -> DataFrame:
    """The distinct (text keys, name) pairs where the text holds the name as it is written.

    The text keys identify a text. Empty and NULL names occur nowhere. One small action finds the kinds of seeds in use,
    eight numbers at most.
    """
    names = names.select(name).where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()
    texts = texts.select(*text_keys, text).where(F.col(text).isNotNull())
    kinds = sorted((r[0] for r in names.select(_class_of(name)).distinct().collect()), reverse=True)
    if not kinds:
        return texts.select(*text_keys, F.col(text).alias(name)).where(F.lit(False))

    def seeds_of(rows: DataFrame, column: str, keys: list[str], whole: bool) -> DataFrame:
        """Rows of keys, ``_kind`` and ``_seed``; a name has seeds of its own kind only, a text of all in use."""
        made = None
        for kind in kinds:
            part = (rows if whole else rows.where(_class_of(column) == kind)).select(
                # an outer explode, as the plain one would have its array worked out for a filter too
                *keys, F.lit(kind).alias("_kind"), F.explode_outer(_seeds(column, kind, whole)).alias("_seed"))
            made = part if made is None else made.unionByName(part)
        return made

    seed = ["_kind", "_seed"]
    own = seeds_of(names, name, [name], False)
    spread = own.groupBy(*seed).agg(F.count(F.lit(1)).alias("_n"))
    rarest = own.join(spread, seed).groupBy(name, "_kind").agg(F.min_by("_seed", F.struct("_n", "_seed")).alias("_seed"))
    candidates = seeds_of(texts, text, text_keys, True).join(rarest, seed).select(*text_keys, name).distinct()
    return (
        candidates.join(texts, text_keys)
        .where(F.instr(F.col(text), F.col(name)) > 0)
        .select(*text_keys, name)
    )


#: Names that are looked for in one copy of a text.
NAMES_AT_ONCE = 1000


def confirmed_pairs(wanted: DataFrame, text_keys: list[str], name: str, texts: DataFrame, text: str) -> DataFrame:
    """Of the given (text keys, name) pairs those, once each, whose text holds the name.

    A text meets its names in one row, or one for each ``NAMES_AT_ONCE`` or so of them, and is not copied per name.
    """
    wanted = wanted.select(*text_keys, name).where(F.col(name) != "").distinct()
    counts = wanted.groupBy(*text_keys).agg(F.count(F.lit(1)).alias("_n"))
    share = F.pmod(F.xxhash64(name), F.ceil(F.col("_n") / NAMES_AT_ONCE))
    together = wanted.join(counts, text_keys).groupBy(*text_keys, share.alias("_share")).agg(
        F.collect_list(name).alias("_names"))
    held = F.filter("_names", lambda n: F.instr(F.col(text), n) > 0)
    return together.join(texts.select(*text_keys, text), text_keys).select(*text_keys, F.explode(held).alias(name))
