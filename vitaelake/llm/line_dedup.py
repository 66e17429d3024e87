"""Near-equal lines by a segment-partition edit join, in DataFrame functions only.

Two lines are linked when no more edits (a character changed, added or dropped) make
them equal than the shorter one may have; ``EDITS`` grows with length. Of a line cut
into edits-plus-one segments one is free of edits and has as many edits before it as
segments. So it lies at the same place from the start, or from the end, give or take
a few characters. Segments are cut for the shortest length of a range of lengths, the
view; a line enters the view of its own length, and those of the shorter lines that it
may be linked with. Lines that meet are verified with a banded bit-parallel edit
distance.

Lines of an entry that more than ``CROWDED`` share and that may have more than one edit
meet by the rarest passages of their text instead: lines of one template by what they
differ in from it, and only those that hardly differ from it by the template.

Lines of an index entry that very many share are not joined there. They are entered
once more under their exact lengths, and what is left open beside the segment, each
part with its own edits, is cut again in the same way, and again, as long as an entry
is crowded. When no more characters are open than edits, the shortest lines of an entry
are all linked with the first one, and are tied to that one. So with one edit a template
with very many fillings costs its lines times the logarithm of their length, with each
further edit its length more, and not their square.

Equal lines are one from the start. Lines without a word are left out; lines of
fewer than ``MIN_CHARS`` characters are only compared for equality. NULL and empty
texts have no lines. Line numbers count from 0. A class is named by its first line,
the smallest (doc_id, line); NULL ids come first. Repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaelake.llm.components import components
from vitaelake.sources.staging import sized, stage

#: Lengths from which lines may have so many edits.
EDITS = ((0, 1), (64, 2), (256, 3))
MIN_CHARS = 10
#: Lines of an entry that are joined outright, and how many times more with each further edit.
CROWDED = 64
CROWDED_TIMES = 16
#: Characters of a passage by which the lines of busy entries meet, and places cut at once.
PASSAGE = 8
PLACES = 256
#: Pieces that are looked for near their place before the edit distance.
PIECES = 16

_BAND_BITS = 32
Edits = tuple[tuple[int, int], ...]

#: Characters that are counted together, in bytes of two long numbers.
_COUNTED = ("e", "a", "i", "o", "n", "r", "t", "s", "l", "u", "d", "c", "m", "h", " ", "0123456789")
_BLANKS = " \t\n\x0b\f\r"


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc, line, content, id of every line with a word; outer whitespace is cut."""
    split = docs.select(F.col(key).alias("doc"), F.posexplode(F.split(F.col(text), "\n", -1)).alias("line", "raw"))
    cut = split.select("doc", "line", F.btrim("raw", F.lit(_BLANKS)).alias("content")).filter("content <> ''")
    return cut.withColumn("id", F.xxhash64("content"))


def _marks(content: Column) -> list[Column]:
    """mark_0 and mark_1: eight counts of characters each, of 255 at most."""

    def count(characters: str) -> Column:
        gone = F.length(F.translate(content, characters, ""))
        return F.least(F.length(content) - gone, F.lit(255)).cast("long")

    def packed(groups: tuple[str, ...]) -> Column:
        out = count(groups[0])
        for place, characters in enumerate(groups[1:], 1):
            out = out.bitwiseOR(F.shiftleft(count(characters), 8 * place))
        return out

    return [packed(_COUNTED[8 * i : 8 * i + 8]).alias(f"mark_{i}") for i in (0, 1)]


def _alike(x: str, y: str, edits: Edits) -> Column:
    """Whether lengths and counts of characters allow two lines to be linked.

    An edit changes two counts by one at most.
    """
    differ = F.lit(0)
    for i in (0, 1):
        for place in range(8):
            a, b = (
                F.shiftrightunsigned(F.col(f"{side}.mark_{i}"), 8 * place).bitwiseAND(F.lit(255)) for side in (x, y)
            )
            differ = differ + F.abs(a - b)
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    k = _allowed(edits, F.least(n, m))
    return (F.abs(n - m) <= k) & (differ <= k * 2)


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row.

    A name given in a select does not do: where a filter is moved below it, the
    expression is put in each place of the name, in every step of a fold.
    """
    return F.transform(F.array(value), use)[0]


def edit_distance(a: Column, b: Column, most: int) -> Column:
    """Edit distance of two strings; more than ``most`` if it is more than that.

    The cells of a band around the diagonal are one number of vertical differences
    (plus one, minus one) per column; a column is a few bitwise operations. The
    distance is followed along the band's lower edge, and then along the last row.
    """
    texts = F.struct(a.alias("a"), b.alias("b"))

    def signs(t: Column) -> Column:
        return F.struct(
            t["a"].alias("a"), t["b"].alias("b"),
            F.split(t["a"], "").alias("rows"), F.split(t["b"], "").alias("columns"),
            F.length(t["a"]).alias("n"), F.length(t["b"]).alias("m"),
        )

    return _once(texts, lambda t: _once(signs(t), lambda s: _banded(s, most)))


def _banded(signs: Column, most: int) -> Column:
    top = 1 << (_BAND_BITS - 1)
    mask = (1 << _BAND_BITS) - 1

    def const(x: int) -> Column:
        return F.lit(x).cast("long")

    rows, columns, n, m = (signs[name] for name in ("rows", "columns", "n", "m"))

    def step(state: Column, j: Column) -> Column:
        symbol = F.get(columns, j)
        equal = const(0)
        for d in range(2 * most + 1):
            row = F.get(rows, F.greatest(j + (most - d), F.lit(-1)))
            hit = F.coalesce((row == symbol) & (j + (most - d) < n), F.lit(False))
            equal = equal.bitwiseOR(F.when(hit, const(top >> d)).otherwise(const(0)))
        return F.struct(
            state["up"].alias("up"), state["down"].alias("down"), state["distance"].alias("distance"),
            equal.alias("equal"), j.alias("j"),
        )

    def moved(s: Column) -> Column:
        up, down, equal = s["up"], s["down"], s["equal"]
        diagonal = (
            (equal.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseOR(equal).bitwiseOR(down).bitwiseAND(const(mask))
        )
        right = down.bitwiseOR(F.bitwise_not(diagonal.bitwiseOR(up))).bitwiseAND(const(mask))
        left = diagonal.bitwiseAND(up)
        shifted = F.shiftright(diagonal, 1)
        # Row of the edge: j + most while that is in the band, then the last row.
        past = F.greatest(s["j"] + (most + 1) - n, F.lit(0))
        on_edge = F.when(diagonal.bitwiseAND(const(top)) == 0, 1).otherwise(0)
        last_row = const(0)
        for d in range(1, 2 * most + 2):
            last_row = F.when(past == d, const(top >> d)).otherwise(last_row)
        along = F.when(right.bitwiseAND(last_row) != 0, 1).otherwise(
            F.when(left.bitwiseAND(last_row) != 0, -1).otherwise(0)
        )
        return F.struct(
            left.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(right))).bitwiseAND(const(mask)).alias("up"),
            shifted.bitwiseAND(right).alias("down"),
            (s["distance"] + F.when(past == 0, on_edge).otherwise(along)).alias("distance"),
        )

    def column_step(state: Column, j: Column) -> Column:
        return _once(step(state, j), moved)

    start = F.struct(
        const(mask & ~(top - 1) | sum(top >> d for d in range(most + 1))).alias("up"),
        const(0).alias("down"),
        F.lit(most).alias("distance"),
    )
    walked = F.aggregate(F.sequence(F.lit(0), m - 1), start, column_step, lambda s: s["distance"])
    near = F.abs(n - m) <= most
    # Strings that end within the first band have no lower edge to follow.
    tiny = F.least(n, m) <= most
    return F.when(near & tiny, F.levenshtein(signs["a"], signs["b"])).when(near, walked).otherwise(most + 1)


def _allowed(edits: Edits, n: Column) -> Column:
    """Edits of a pair whose shorter line has ``n`` characters."""
    out = F.lit(0)
    for length, most in sorted(edits):
        out = F.when(n >= length, most).otherwise(out)
    return out


def _view(edits: Edits, n: Column) -> Column:
    """The lengths, an eighth or less apart, and the edits of the view of length ``n``."""
    width = F.pow(F.lit(2), F.greatest(F.length(F.bin(n)) - 4, F.lit(0))).cast("int")
    low = n - F.pmod(n, width)
    high = low + width - 1
    for length, _ in sorted(edits):
        low = F.when(n >= length, F.greatest(low, F.lit(length))).otherwise(low)
        high = F.when(n < length, F.least(high, F.lit(length - 1))).otherwise(high)
    return F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"), _allowed(edits, n).alias("edits"))


def _part(start: Column, size: Column, view: Column, budget: Column) -> Column:
    """An open part of a line, the size it is cut for, and the edits it may have."""
    named = {"start": start, "size": size, "view": view, "budget": budget}
    return F.struct(*(column.cast("int").alias(name) for name, column in named.items()))


def _closed(part: Column) -> Column:
    return (part["view"] <= 0) | ((part["budget"] > 1) & (part["view"] <= part["budget"]))


def _segments(budget: Column, most: int) -> Column:
    """(i, further, spare): segment, how much further in it is taken, and the most of that."""
    out = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("further"), F.lit(0).alias("spare")))
    for edits in range(1, most + 1):
        every = [(i, d, min(i, edits - i)) for i in range(edits + 1) for d in range(min(i, edits - i) + 1)]
        rows = [F.struct(F.lit(i).alias("i"), F.lit(d).alias("further"), F.lit(r).alias("spare")) for i, d, r in every]
        out = F.when(budget == edits, F.array(*rows)).otherwise(out)
    return out


def _placed(dealt: DataFrame, m: Column, v: Column, budget: Column) -> DataFrame:
    """Add front, size, place and begin of segment ``s`` of a part of ``m`` characters cut for ``v``."""
    i, further, spare = F.col("s.i"), F.col("s.further"), F.col("s.spare")
    whole = F.floor(v / (budget + 1)).cast("int")
    whole = F.when(budget == 1, F.greatest(whole, F.least(v, F.lit(1)))).otherwise(whole)
    front = i * 2 <= budget
    sized_ = dealt.withColumns({
        "front": front,
        "size": F.greatest(whole - spare, F.lit(0)),
        "place": F.when(front, i).otherwise(budget - i) * whole,
    })
    size, place = F.col("size"), F.col("place")
    begin = F.when(F.col("front"), place + further).otherwise(m - place - further - size)
    return sized_.withColumn("begin", begin.cast("int")).filter((F.col("begin") >= 0) & (F.col("begin") + size <= m))


def _viewed(long: DataFrame, edits: Edits) -> DataFrame:
    """All lines in their views ``v``; ``guest`` has lines that are longer than the view."""
    most = max(k for _, k in edits)
    lengths = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(most)), lambda t: F.col("n") - t), lambda n: n >= MIN_CHARS
    )
    views = F.array_distinct(F.transform(lengths, lambda n: _view(edits, n)))
    viewed = long.withColumn("v", F.explode(views)).filter("n - v.high <= v.edits AND v.edits > 0")
    return viewed.withColumn("guest", (F.col("n") > F.col("v.high")).cast("int"))


def _entries(long: DataFrame, edits: Edits) -> DataFrame:
    """The entries of all lines in their views, with lengths."""
    most = max(k for _, k in edits)
    dealt = _viewed(long, edits).withColumn("s", F.explode(_segments(F.col("v.edits"), most)))
    placed = _placed(dealt, F.col("n"), F.col("v.low"), F.col("v.edits"))
    piece = F.substring(F.col("content"), F.col("begin") + 1, F.col("size"))
    return placed.select(
        "id", "n", "v.edits", "guest", F.xxhash64("v.low", "s.i", piece).alias("key"),
    )


def _rare(lines: DataFrame, edits: Edits) -> DataFrame:
    """Entries of these lines by the rarest passages of their text, in their views.

    Of passages that lie apart, one more than edits, one is in the other line, too.
    All passages have one order, rare ones first. A line is entered with those up to the
    last of edits-plus-one that lie apart. Of two linked lines this comes first in
    one, and the other one is entered with all that it has up to there. Each passage
    that is taken rules out fewer than two sizes of places, so there always are enough.
    """
    low, budget, size, place = (F.col(name) for name in ("v.low", "v.edits", "size", "place"))
    most_size = F.floor((low + budget) / (budget * 2 + 1))
    viewed = _viewed(lines, edits).withColumn("size", F.least(F.lit(PASSAGE), most_size).cast("int"))
    parts = viewed.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("n") - size, F.lit(PLACES)))).select(
        "id", low.alias("low"), "size", "at", F.substring(F.col("content"), F.col("at") + 1, size + (PLACES - 1)).alias("part")
    )
    cut = parts.withColumn("place", F.explode(F.sequence(F.lit(0), F.length("part") - size)))
    placed = stage(cut.select(
        "id", "low", (F.col("at") + place).alias("place"),
        F.xxhash64("low", F.substring(F.col("part"), place + 1, size)).alias("key"),
    ), "line-passages")
    counts = placed.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1")
    # A passage that is there once is met by no other line, but counts among those apart.
    counted = placed.join(sized(stage(counts, "passages")), "key", "left")
    # Of equally rare ones the first is taken, so that a changed word gives two.
    ranked = F.struct(F.coalesce("rows", F.lit(1)).alias("rows"), F.col("place"), F.col("key"))
    gathered = counted.groupBy("id", "low").agg(F.collect_list(ranked).alias("places"))

    def next_apart(taken: Column, _: Column) -> Column:
        free = F.filter("places", lambda p: ~F.exists(taken, lambda t: F.abs(t["place"] - p["place"]) < size))
        return F.concat(taken, F.array(F.array_min(free)))

    def up_to_last(taken: Column) -> Column:
        last = F.array_max(F.transform(taken, _rank))

        def own(last: Column) -> Column:
            entered = F.filter("places", lambda p: (p["rows"] > 1) & (_rank(p) <= last))
            return F.struct(
                taken.alias("taken"), last.alias("last"), entered.alias("entered"),
                F.array_distinct(F.transform(entered, lambda p: p["key"])).alias("keys"),
            )

        return _once(last, own)

    own = viewed.select(*_LINE, "guest", "size", low.alias("low"), budget.alias("edits"))
    joined = gathered.join(own, ["id", "low"])
    start = F.slice("places", F.lit(1), F.lit(0))
    taken = F.aggregate(F.sequence(F.lit(0), F.col("edits")), start, next_apart)
    chosen = stage(joined.select(*_LINE, "edits", "guest", "size", _once(taken, up_to_last).alias("own")), "rare-lines")
    return chosen.select("*", F.explode("own.keys").alias("key"))


def _rank(passage: Column) -> Column:
    """The order of all passages."""
    return F.struct(passage["rows"].alias("rows"), passage["key"].alias("key"))


def _missing(x: str, y: str) -> Column:
    """Places of passages taken in one line that the other one does not have near there."""
    last, k = F.col(f"{y}.own.last"), F.col(f"{x}.edits")

    def there(p: Column) -> Column:
        return F.exists(
            F.col(f"{y}.own.entered"), lambda q: (q["key"] == p["key"]) & (F.abs(q["place"] - p["place"]) <= k)
        )

    gone = F.filter(F.col(f"{x}.own.taken"), lambda p: (p["rows"] == 1) | ((_rank(p) <= last) & ~there(p)))
    return F.transform(gone, lambda p: p["place"])


def _few_missing(x: str, y: str) -> Column:
    """Whether the passages that one of two lines lacks need no more edits than there may be.

    An edit spoils one of a line's passages that lie apart, and none of the other
    line's that begins a passage and all the edits further off.
    """
    apart, k = F.col(f"{x}.size") + F.col(f"{x}.edits"), F.col(f"{x}.edits")

    def few(here: Column) -> Column:
        others = F.filter(_missing(y, x), lambda p: ~F.exists(here, lambda q: F.abs(p - q) < apart))
        return F.size(here) + F.size(others) <= k

    return _once(_missing(x, y), few)


def _cut(entries: DataFrame, most: int) -> DataFrame:
    """Entries of each segment of the widest open part, and what is open beside it.

    Segments up to the middle are counted from the start, the others from the end. Of
    two linked lines one has the segment in its place, and the other one a few
    characters further in, so the segment is shorter by as many. The part that the
    segment is counted from is as wide as its place; of the other the narrower of the
    two lines is not known, so every width is entered. ``guest`` has a bit for each
    part that is longer than its view.
    """
    widths = F.transform("open", lambda o, j: F.struct(F.when(_closed(o), -1).otherwise(o["view"]).alias("w"), (-j).alias("j")))
    chosen = entries.withColumn("at", -F.array_max(widths)["j"]).withColumn("o", F.get("open", F.col("at")))
    dealt = chosen.withColumn("s", F.explode(_segments(F.col("o.budget"), most)))
    m, v, budget = F.col("o.size"), F.col("o.view"), F.col("o.budget")
    i, spare = F.col("s.i"), F.col("s.spare")
    placed = _placed(dealt, m, v, budget)
    begin, size, place = F.col("begin"), F.col("size"), F.col("place")
    piece = F.substring(F.col("content"), F.col("o.start") + begin + 1, size)
    beside = F.when(F.col("front"), m - begin - size).otherwise(begin)
    free = F.when(F.col("front"), budget - i).otherwise(i)
    wide = F.transform(F.sequence(F.lit(0), free), lambda t: beside - t)
    most_wide = v - place - size
    fitting = F.filter(wide, lambda w: (w >= 0) & (w <= most_wide) & (w >= most_wide - spare))
    viewed = placed.withColumn("wide", F.explode(fitting))
    left = _part(F.col("o.start"), begin, F.when(F.col("front"), place).otherwise(F.col("wide")), i)
    right = _part(
        F.col("o.start") + begin + size, m - begin - size,
        F.when(F.col("front"), F.col("wide")).otherwise(place), budget - i,
    )
    parts = F.concat(
        F.slice("open", F.lit(1), F.col("at")), F.array(left, right),
        F.slice("open", F.col("at") + 2, F.size("open")),
    )
    return viewed.select(
        "id", "n", "mark_0", "mark_1", "edits", F.filter(parts, lambda o: o["budget"] > 0).alias("open"),
        F.xxhash64("key", "at", "s.i", "wide", piece).alias("key"),
    )


def _guest(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda bits, o: bits * 2 + (o["size"] > o["view"]).cast("int"))


_LINE = ("id", "n", "mark_0", "mark_1")


def _met(
    entries: DataFrame, keys: DataFrame, edits: Edits, labels: DataFrame | None = None, rare: bool = False
) -> DataFrame:
    """(a, b) of the lines of these entries that may be linked and are not in one class yet.

    In each part one of the two is as short as its view. ``rare`` entries have passages,
    which are compared last.
    """
    met = entries.join(keys, "key").select("key", *_LINE, "guest", *(("edits", "size", "own") if rare else ()))
    differ = F.lit(True)
    if labels is not None:
        met = met.join(labels, met["id"] == labels["node"], "left").withColumn("label", F.coalesce("component", "id"))
        differ = F.col("x.label") != F.col("y.label")
    x, y = met.alias("x"), met.alias("y")
    short = F.col("x.guest").bitwiseAND(F.col("y.guest")) == 0
    same = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))
    condition = same & short & differ & _alike("x", "y", edits)
    if rare:
        # A pair is made at the first of the entries that the two share.
        once = F.col("x.key") == F.array_min(F.array_intersect("x.own.keys", "y.own.keys"))
        condition = condition & once & _few_missing("x", "y")
    joined = x.join(y, condition)
    return joined.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def _stars(entries: DataFrame, shared: DataFrame, edits: Edits) -> DataFrame:
    """(a, b): each line of an entry with the first of the shortest ones."""
    first = shared.filter("first IS NOT NULL").select("key", "first")
    joined = entries.select("key", F.struct(*_LINE).alias("own")).join(first, "key")
    joined = joined.filter((F.col("own.id") != F.col("first.id")) & _alike("own", "first", edits))
    return joined.select(
        F.least("own.id", "first.id").alias("a"), F.greatest("own.id", "first.id").alias("b")
    ).distinct()


def _shared(entries: DataFrame, open_: Column, tied: Column) -> DataFrame:
    """key, crowded, tied and first of the entries in which lines meet."""
    counted = entries.groupBy("key").agg(
        F.count("*").alias("rows"), F.max("edits").alias("edits"), F.max(open_).alias("open"),
        F.max(tied).alias("tied"), F.min(F.when(F.col("guest") == 0, F.struct(*_LINE))).alias("first"),
    )
    many = F.lit(CROWDED) * F.pow(F.lit(CROWDED_TIMES), F.col("edits") - 1)
    crowded = (F.col("rows") > many) & F.col("open")
    return stage(
        counted.filter("rows > 1").select(
            "key", "first", "tied", crowded.alias("crowded"), (F.col("rows") > CROWDED).alias("busy")
        ), "shared-entries"
    )


def _starred(lines: DataFrame, entries: DataFrame, shared: DataFrame, edits: Edits) -> DataFrame:
    """Links of the lines with one line of each of their entries."""
    return stage(_verified(lines, _stars(entries, shared, edits), edits), "star-links")


def _pairs(
    lines: DataFrame, entries: DataFrame, shared: DataFrame, edits: Edits, labels: DataFrame | None
) -> DataFrame:
    """(a, b): ids of lines that may be linked; ``lines`` has id, content, n and marks."""
    plain = shared.filter("NOT crowded AND NOT busy").select("key")
    busy = shared.filter("NOT crowded AND busy").select("key")
    pairs = _met(entries, plain, edits, labels)
    if not busy.isEmpty():
        ids = sized(stage(entries.join(busy, "key", "left_semi").select("id").distinct(), "busy-lines"))
        rare = _rare(lines.join(ids, "id", "left_semi"), edits)
        keys = rare.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
        pairs = pairs.union(_met(rare, keys, edits, labels, rare=True))
    pairs = stage(pairs.distinct(), "line-pairs")
    crowded = shared.filter("crowded").select("key")
    if crowded.isEmpty():
        return pairs
    return pairs.union(_like(lines, _crowded_pairs(lines, entries, crowded, edits).distinct(), edits))


def _crowded_pairs(lines: DataFrame, entries: DataFrame, crowded: DataFrame, edits: Edits) -> DataFrame:
    """Pairs of the lines of crowded entries, which are cut again until they are not."""
    most = max(k for _, k in edits)
    again = stage(entries.join(crowded, "key", "left_semi").select("id").distinct(), "crowded-lines")
    lengths = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(most)), lambda t: F.col("n") - t), lambda n: n >= MIN_CHARS
    )
    exact = lines.join(again, "id", "left_semi").withColumn("v", F.explode(lengths))
    exact = exact.withColumn("edits", _allowed(edits, F.col("v"))).filter("edits > 0 AND n - v <= edits")
    current = _cut(exact.select(
        *_LINE, "content", "edits", F.xxhash64("v").alias("key"),
        F.array(_part(F.lit(0), F.col("n"), F.col("v"), F.col("edits"))).alias("open"),
    ), most)
    found = None
    while True:
        entries = stage(current.withColumn("guest", _guest(F.col("open"))).distinct(), "line-entries")
        narrow = F.aggregate("open", F.lit(True), lambda all_, o: all_ & (o["view"] <= o["budget"]))
        shared = _shared(entries, F.exists("open", lambda o: ~_closed(o)), narrow)
        # Where nothing can be cut, the shortest lines are tied, and not joined with each other.
        firsts = shared.filter("tied").select("key", F.col("first.id").alias("first"))
        tied = entries.filter("guest = 0").join(firsts, "key")
        pairs = tied.filter("id <> first").select(F.least("first", "id").alias("a"), F.greatest("first", "id").alias("b"))
        longer = entries.filter("guest <> 0").select("key", F.col("id").alias("i"), F.col("guest").alias("g"))
        others = entries.join(shared.filter("tied AND NOT crowded").select("key"), "key").select("key", "id", "guest")
        beside = others.join(longer, "key").filter(F.col("g").bitwiseAND(F.col("guest")) == 0).filter("id <> i")
        pairs = pairs.union(beside.select(F.least("id", "i").alias("a"), F.greatest("id", "i").alias("b")))
        pairs = pairs.union(_met(entries, shared.filter("NOT crowded AND NOT tied").select("key"), edits))
        pairs = stage(pairs.distinct(), "line-pairs")
        found = pairs if found is None else found.union(pairs)
        crowded = shared.filter("crowded").select("key")
        if crowded.isEmpty():
            return found
        open_ = entries.join(crowded, "key", "left_semi").drop("guest")
        current = _cut(open_.join(lines.select("id", "content"), "id"), most)


def _ready(lines: DataFrame, edits: Edits) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines that share an entry, with marks, their shared entries, and one row for each of those.

    Most lines share none; they are neither marked nor kept with their text again.
    """
    most = max(k for _, k in edits)
    if 2 * most + 1 > _BAND_BITS or [k for _, k in sorted(edits)] != sorted(k for _, k in edits):
        raise ValueError(f"edits must not fall with length, nor be more than {(_BAND_BITS - 1) // 2}")
    measured = lines.select("id", "content", F.length("content").alias("n"))
    every = stage(_entries(measured.filter(F.col("n") >= MIN_CHARS), edits), "line-entries")
    keys = every.groupBy("key").agg(F.count("*").alias("rows")).filter("rows > 1").select("key")
    met = stage(every.join(sized(stage(keys, "shared-keys")), "key", "left_semi"), "met-entries")
    ids = sized(stage(met.select("id").distinct(), "entered-ids"))
    marked = stage(measured.join(ids, "id", "left_semi").select("*", *_marks(F.col("content"))), "marked-lines")
    entries = stage(met.join(marked.select("id", "mark_0", "mark_1"), "id"), "marked-entries")
    return marked, entries, _shared(entries, F.lit(True), F.lit(False))


def links(lines: DataFrame, edits: Edits = EDITS) -> DataFrame:
    """(a, b) of distinct lines, given as id and content, that are within their edits."""
    marked, entries, shared = _ready(lines, edits)
    return _verified(marked, _pairs(marked, entries, shared, edits, None).distinct(), edits)


def class_links(lines: DataFrame, edits: Edits = EDITS) -> DataFrame:
    """Links that make the same classes as all of them.

    Lines are first compared with one line of each of their entries. What that links is
    one class already, and no further pairs are made of it, so a large group of near
    copies costs its lines and not their square.
    """
    marked, entries, shared = _ready(lines, edits)
    stars = _starred(marked, entries, shared, edits)
    labels = sized(stage(components(stars, "a", "b"), "star-classes"))
    pairs = _pairs(marked, entries, shared, edits, labels).distinct()
    return stars.union(_verified(marked, pairs, edits)).distinct()


def _like(lines: DataFrame, pairs: DataFrame, edits: Edits) -> DataFrame:
    """The pairs, met without a look at their marks, that may be linked by them."""
    pairs = stage(pairs, "met-lines")
    ids = sized(stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "met-ids"))
    marks = sized(stage(lines.join(ids, "id", "left_semi").select(*_LINE), "line-marks"))
    for side in "ab":
        own = marks.select(F.col("id").alias(side), F.struct("n", "mark_0", "mark_1").alias(f"own_{side}"))
        pairs = pairs.join(own, side)
    return pairs.filter(_alike("own_a", "own_b", edits)).select("a", "b")


def _verified(lines: DataFrame, pairs: DataFrame, edits: Edits) -> DataFrame:
    """The pairs that are within their edits."""
    pairs = stage(pairs, "like-lines")
    ids = sized(stage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "like-ids"))
    texts = lines.join(ids, "id", "left_semi")
    sides = [texts.select(F.col("id").alias(s), F.col("content").alias(f"text_{s}")) for s in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b")
    swapped = F.length("text_a") > F.length("text_b")
    ordered = both.select(
        "a", "b",
        F.when(swapped, F.col("text_b")).otherwise(F.col("text_a")).alias("x"),
        F.when(swapped, F.col("text_a")).otherwise(F.col("text_b")).alias("y"),
    )
    n = F.length("x")
    pair = F.struct("x", "y", n.alias("n"), F.length("y").alias("m"), _allowed(edits, n).alias("k"))
    kinds = sorted({k for _, k in edits if k > 0})
    linked = _once(pair, lambda p: _once(_stripped(p), lambda o: _near(o, kinds)))
    return ordered.select("a", "b", linked.alias("linked")).filter("linked").select("a", "b")


def _same(n: Column, equal: Callable[[Column], Column]) -> Column:
    """The largest length up to ``n`` that is ``equal``, by halving."""
    def halved(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        return F.when(s["low"] >= s["high"], s).when(
            equal(middle), F.struct(middle.alias("low"), s["high"].alias("high"))
        ).otherwise(F.struct(s["low"].alias("low"), (middle - 1).alias("high")))

    start = F.struct(F.lit(0).alias("low"), n.cast("int").alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(n))), start, halved, lambda s: s["low"])


def _stripped(pair: Column) -> Column:
    """A pair without what is equal at its front and at its back."""
    x, y, n, m, k = (pair[name] for name in ("x", "y", "n", "m", "k"))

    def rest(front: Column) -> Column:
        back = _same(n - front, lambda t: F.substring(x, n - t + 1, t) == F.substring(y, m - t + 1, t))
        return _once(back, lambda b: F.struct(
            F.substring(x, front + 1, n - front - b).alias("x"), F.substring(y, front + 1, m - front - b).alias("y"),
            (n - front - b).alias("n"), (m - front - b).alias("m"), k.alias("k"),
        ))

    return _once(_same(n, lambda t: F.substring(x, F.lit(1), t) == F.substring(y, F.lit(1), t)), rest)


def _near(pair: Column, kinds: list[int]) -> Column:
    """Whether a stripped pair is within its edits.

    An edit spoils one piece at most, and the others are in the other line, near by.
    """
    x, y, n, m, k = (pair[name] for name in ("x", "y", "n", "m", "k"))
    size = F.floor(n / PIECES).cast("int")

    def found(j: Column) -> Column:
        around = F.substring(y, F.greatest(j * size - k, F.lit(0)) + 1, size + 2 * k)
        return F.contains(around, F.substring(x, j * size + 1, size))

    pieces = F.filter(F.sequence(F.lit(0), F.lit(PIECES - 1)), found)
    possible = (m - n <= k) & ((size == 0) | (F.size(pieces) >= PIECES - k))
    within = F.lit(False)
    for most in kinds:
        within = F.when(k == most, edit_distance(x, y, most) <= most).otherwise(within)
    return F.when(possible, within).otherwise(False)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: Edits = EDITS) -> DataFrame:
    """key, line, class_doc, class_line and kept of every line with a word.

    A line is kept where it is the first of its class. ``edits`` has pairs of a length
    and the edits that lines of this length or more may have, of two the shorter one.
    """
    every = _lines(docs, key, text)
    where = stage(every.select("doc", "line", "id"), "line-places")
    counts = where.groupBy("id").agg(F.count("*").alias("rows"))
    repeated = sized(stage(counts.filter("rows > 1").select("id"), "repeated-lines"))
    # Only lines that repeat are shuffled with their text, after taking one per task.
    single = every.join(repeated, "id", "left_anti").select("id", "content")
    several = every.join(repeated, "id", "left_semi").groupBy("id").agg(F.min("content").alias("content"))
    lines = stage(single.union(several), "distinct-lines")
    labels = sized(stage(components(stage(class_links(lines, edits), "line-links"), "a", "b"), "line-classes"))
    named = where.join(labels, where["id"] == labels["node"], "left").select(
        "doc", "line", F.coalesce("component", "id").alias("class")
    )
    first = named.groupBy("class").agg(
        F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("rows")
    )
    shared = first.filter("rows > 1").select("class", "first")
    joined = named.join(shared, "class", "left")
    own = F.struct("doc", "line")
    chosen = F.coalesce("first", own)
    return joined.select(
        F.col("doc").alias(key), "line",
        chosen["doc"].alias("class_doc"), chosen["line"].alias("class_line"),
        (chosen["doc"].eqNullSafe(F.col("doc")) & (chosen["line"] == F.col("line"))).alias("kept"),
    )
