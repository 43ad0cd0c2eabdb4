"""Line dedup by a segment-partition edit join, with DataFrame functions only.

A line goes if an equal line, or one within a few edits of it, stands earlier
in the corpus (by doc_id, then line number). How many edits are allowed grows
with the shorter line's length (``LEVELS``: 1 from 24 characters on, 2 from 64,
3 from 512). Lines shorter than the first level must be equal; lines without a
word are left alone.

Edit join: a line of m characters with t edits allowed is cut into t + 1
segments of equal length (give or take one). Within t edits one of them
survives, at a place that the lengths bound, so a line of n >= m characters
probes the index of lines of each length m with its substrings at those places
only. Index entries are (length, segment, hash of the segment). A pair is
verified by edit distance on a band of 2t + 1 diagonals, one bit-parallel step
for each character (the band slides down in one word).

Scale: lines are written once as hashes (a 128-bit one of the line, and those of
its entries); everything up to the verification works on these. Equal lines
collapse before any pair is made, and entries that only one line has end in one
pre-aggregated shuffle. A segment that many different lines share does not
become all their pairs:

1. each line is compared with the earliest line of each of its own index
   entries; one that is verified goes, and needs no other partner;
2. in an entry with more than ``CROWD`` lines, its open lines are compared with
   the earliest ``PIVOTS`` lines, then with the earliest that are still open; near
   copies of one line, however many, are settled here, in steps linear in them;
3. lines still open meet the other lines of their entries where these are not
   crowded;
4. lines of crowded entries (lines of a template, say) get finer keys: the
   shorter line is cut into segments of ``FINE`` characters and indexed by the
   t + 1 *rarest* of them. At most t of these are lost to t edits, so the longer
   line, which probes every segment at every place it can have (a segment's place
   is the same in lines of all lengths, so each is read once), still meets
   it. What a template's lines have in common is frequent and therefore no key.
   Lines are read in stretches of ``STRETCH`` characters, dealt evenly to tasks
   whose number grows with the characters.

A pair leaves a join only if the counts of 24 letters and eight digits
differ by at most 2t in all, which t edits imply. No pair is lost in any step.
Lines of one template meet in pairs only as far as their differing part is
shorter than about t + 1 finer segments.

Texts never enter the joins of entries; the few lines with a shared entry are
fetched again for the counts, the finer keys and the verification. A side is
broadcast if it has at most ``BROADCAST`` entries, and shuffled otherwise.
Equi-joins on a hot line or segment are split by adaptive execution.

Defined cases: a null text stays null; rows without an id come last in the
order; rows that agree in id and text are one document; a text whose lines
all go becomes empty; an empty table gives no rows; other columns are kept
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.shared import cut, run_dir, slots

#: Edits allowed for a pair whose shorter line has at least so many characters.
LEVELS = ((24, 1), (64, 2), (512, 3))
BROADCAST = 1_000_000
#: An entry with more lines than this is crowded.
CROWD = 16
#: Earliest lines of a crowded entry that all of its lines are compared with, and how often.
PIVOTS, ROUNDS = 8, 2
#: Lines up to this length read the places of their entries from a table, longer ones work them out.
TABLED = 4096
#: Characters of the finer segments.
FINE = 8
#: Characters of a line whose finer segments are read in one row, and how many such rows make a task.
STRETCH, DEALT = 512, 64
#: Signs whose counts a candidate pair must nearly share, eight to a number.
SIGNS = ("etaoinhr", "dlcumfpg", "wybvkxjq", "01234567")
COUNTS = tuple(f"c{i}" for i in range(len(SIGNS)))
LAST = (1 << 63) - 1


Levels = tuple[tuple[int, int], ...]


def allowed(length: str, levels: Levels) -> str:
    """SQL of the edits allowed for a shorter line of this length; 0 below the first level."""
    return "case " + " ".join(f"when {length} >= {least} then {k}" for least, k in sorted(levels, reverse=True)) + " else 0 end"


def _shifts(less: int, threshold: int) -> list[int]:
    """By how much a piece of a line can move in one that is ``less`` longer, within the threshold."""
    return [s for s in range(-threshold, threshold + 1) if abs(s) + abs(less - s) <= threshold]


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _segment(shift: str) -> str:
    """SQL of segment i of a line of m characters with t edits allowed, and where it is read, ``shift`` places on.

    The m characters make t + 1 segments; the last m % (t + 1) of them are one longer.
    """
    size = "cast(m div (t + 1) + if(i > t - m % (t + 1), 1, 0) as int)"
    start = f"cast(i * (m div (t + 1)) + greatest(0, i - (t + 1 - m % (t + 1))) + {shift} as int)"
    return f"struct(cast(m as int) as m, i as i, {start} + 1 as at, {size} as size)"


def index_places(levels: Levels, length: str = "n") -> str:
    """SQL of a line's own segments."""
    return _let(length, "m", _let(allowed("m", levels), "t", f"transform(sequence(0, t), i -> {_segment('0')})"))


def probe_places(levels: Levels, length: str = "n") -> str:
    """SQL of the places where a line can hold a segment of another one that is near it, and not longer.

    For a line shorter by d with t edits, at most i edits lie before segment i
    and at most t - i after it, which bounds the segment's shift. The loops are
    over arrays: unrolled, the expression is too long for the JVM to compile.
    """
    most = max(k for _, k in levels)
    shifts = f"transform(filter(sequence(greatest(-i, d - (t - i)), least(i, d + t - i)), s -> d <> 0 or s <> 0), s -> {_segment('s')})"
    none = "cast(array() as array<struct<m: int, i: int, at: int, size: int>>)"
    each = f"if(d <= t and m >= {min(x for x, _ in levels)}, flatten(transform(sequence(0, t), i -> {shifts})), {none})"
    return f"flatten(transform(sequence(0, {most}), d -> {_let(f'{length} - d', 'm', _let(allowed('m', levels), 't', each))}))"


def _fine(length: str, levels: Levels) -> str:
    """SQL of the size of a line's finer segments: it has at least one more than the edits allowed."""
    return f"cast(least({FINE}, {length} div ({allowed(length, levels)} + 1)) as int)"


def _stretches(lines: DataFrame, levels: Levels) -> DataFrame:
    """The lines as rows of ``part``, with ``first``, the first of up to ``STRETCH`` characters where a segment of it starts.

    A part begins at ``base`` and also holds what segments that start in it need
    on both sides. Parts are dealt evenly to tasks of ``DEALT`` each, so that
    neither many lines nor a long one lie in one task, and no segment is
    counted off from the start of a long line.
    """
    most = max(k for _, k in levels)
    parts = lines.agg(F.sum(F.expr(f"(n - 1) div {STRETCH} + 1"))).first()[0] or 0
    tasks = min(max(1, -(-parts // DEALT)), 16 * slots(lines.sparkSession))
    each = lines.withColumn("first", F.explode(F.expr(f"transform(sequence(0, cast((n - 1) div {STRETCH} as int)), q -> q * {STRETCH})")))
    each = each.withColumn("base", F.expr(f"greatest(first - {most}, 0)"))
    return each.withColumn("part", F.expr(f"substring(line, base + 1, {STRETCH + FINE + 2 * most})")).drop("line").repartition(tasks)


def _started(z: str) -> str:
    """SQL of the numbers j of the finer segments of z characters that start in a stretch."""
    start, end = f"cast((first + {z} - 1) div {z} as int)", f"cast(least(n div {z}, (first + {STRETCH} + {z} - 1) div {z}) as int)"
    return f"if({start} < {end}, sequence({start}, {end} - 1), cast(array() as array<int>))"


def fine_index(lines: DataFrame, levels: Levels) -> DataFrame:
    """The lines with j and key of every finer segment, a row each; segments lie end to end from the line's start."""
    each = _stretches(lines, levels).withColumn("z", F.expr(_fine("n", levels))).withColumn("j", F.explode(F.expr(_started("z"))))
    return each.withColumn("key", F.expr("xxhash64(z, j, substring(part, j * z - base + 1, z))")).drop("first", "base", "part", "z")


def fine_probe(lines: DataFrame, levels: Levels) -> DataFrame:
    """The lines with s and key of every place, s on, where they can hold a finer segment of a line near them and not longer.

    A segment's place does not depend on its line's length (its size only where
    lines are short), so a place is read once for all lengths within the edits.
    """
    sizes = f"array_distinct(transform(filter(sequence(0, t), d -> n - d >= {min(x for x, _ in levels)}), d -> {_fine('(n - d)', levels)}))"
    spots = "transform(sequence(cast(-(t div 2) as int), t), s -> struct(z, j, s))"
    places = f"filter(flatten(transform({sizes}, z -> flatten(transform({_started('z')}, j -> {spots})))), p -> p.j * p.z + p.s between 0 and n - p.z)"
    each = _stretches(lines, levels).withColumn("t", F.expr(allowed("n", levels))).withColumn("p", F.explode(F.expr(places)))
    keyed = {"s": F.col("p.s"), "key": F.expr("xxhash64(p.z, p.j, substring(part, p.j * p.z + p.s - base + 1, p.z))")}
    return each.withColumns(keyed).drop("first", "base", "part", "t", "p")


def _shared(a: str, b: str, most: str, cut_of: str) -> str:
    """SQL of how many leading (or trailing) characters two lines share, at most ``most``, by halving steps."""
    part = {"head": "substring({0}, p + 1, shiftleft(1, k))", "tail": "substring({0}, char_length({0}) - p - shiftleft(1, k) + 1, shiftleft(1, k))"}[cut_of]
    longer = f"if(p + shiftleft(1, k) <= {most} and {part.format(a)} = {part.format(b)}, p + shiftleft(1, k), p)"
    steps = f"sequence(cast(floor(log2(greatest({most}, 1))) as int), 0, -1)"
    return f"aggregate({steps}, 0, (p, k) -> {longer})"


def reaches(a: str, b: str, threshold: int) -> Column:
    """Whether ``threshold`` edits can lead from the start of both lines to their ends.

    For each number of edits and each diagonal, the furthest place reached: one
    edit on, then as far as both lines agree, found by halving steps. A few
    dozen comparisons of substrings, so that a pair which shares long parts but
    has too many edits costs no pass over its characters.
    """
    k = threshold
    same = "substring(u.a, c + p + 1, shiftleft(1, h)) = substring(u.b, c + g + p + 1, shiftleft(1, h))"
    most = "least(u.n - c, u.m - c - g)"
    agree = f"aggregate(sequence(cast(floor(log2(greatest({most}, 1))) as int), 0, -1), 0, (p, h) -> if(p + shiftleft(1, h) <= {most} and {same}, p + shiftleft(1, h), p))"
    onward = lambda place: _let(place, "c", f"if(c is null, cast(null as int), c + {agree})")
    begin = f"transform(sequence({-k}, {k}), g -> {onward('if(g = 0, 0, cast(null as int))')})"
    before = f"get(far, g + {k}), get(far, g + {k - 1}), get(far, g + {k + 1})"  # null: not reached
    furthest = f"least(greatest(get(far, g + {k}) + 1, get(far, g + {k - 1}), get(far, g + {k + 1}) + 1), u.n, u.m - g)"
    step = onward(f"if(coalesce({before}) is null, cast(null as int), {furthest})")
    whole = f"aggregate(sequence(1, {k}), {begin}, (far, e) -> transform(sequence({-k}, {k}), g -> {step}), far -> coalesce(get(far, u.m - u.n + {k}) >= u.n, false))"
    pair = f"named_struct('a', {a}, 'b', {b}, 'n', char_length({a}), 'm', char_length({b}))"
    return F.expr(_let(pair, "u", f"abs(u.n - u.m) <= {k} and {whole}"))


def within(a: str, b: str, threshold: int) -> Column:
    """Whether two lines are within the threshold: banded bit-parallel edit distance.

    What the lines share at their ends is left out, which does not change the
    distance. Bit t of a word stands for row i - threshold + t of column i:
    ``vp`` and ``vn`` mark where the distance grows or falls from one row to
    the next.
    """
    k = threshold
    mask, top = (1 << (2 * k + 1)) - 1, 1 << (2 * k)
    first = mask & ~((1 << k) - 1)
    match = " | ".join(f"if(coalesce(get(s.a, i - {k} + {t}) = get(s.b, i), false), {1 << t}L, 0L)" for t in range(2 * k + 1))
    place = f"cast({2 * k} - 1 - (i - (size(s.a) - {k})) as int)"
    dist = f"""s.d + if(i < size(s.a) - {k}, if((z.d0 & {top}L) = 0, 1, 0),
        cast((shiftright(z.hp, {place}) & 1L) - (shiftright(z.hn, {place}) & 1L) as int))"""
    end = f"""named_struct('a', s.a, 'b', s.b, 'vp', z.hn | (~(shiftright(z.d0, 1) | z.hp) & {mask}L), 'vn', shiftright(z.d0, 1) & z.hp, 'd', {dist})"""
    hori = f"named_struct('d0', y, 'hp', s.vn | (~(y | s.vp) & {mask}L), 'hn', y & s.vp)"
    d0 = f"(((((x & s.vp) + s.vp) ^ s.vp) | x | s.vn) & {mask}L)"
    step = _let(match, "x", _let(d0, "y", _let(hori, "z", end)))
    # a band needs more rows than the threshold: both get the same end
    start = f"named_struct('a', split(concat(m.a, '{'#' * (k + 1)}'), ''), 'b', split(concat(m.b, '{'#' * (k + 1)}'), ''), 'vp', {first}L, 'vn', 0L, 'd', {k})"
    whole = f"aggregate(sequence(0, char_length(m.b) + {k}), {start}, (s, i) -> {step}, s -> s.d <= {k})"
    near = f"abs(char_length(m.a) - char_length(m.b)) <= {k} and {whole}"
    least = f"least(char_length({a}), char_length({b}))"
    head = _shared(a, b, "n", "head")
    tail = _shared(a, b, "(n - h)", "tail")
    middle = f"named_struct('a', substring({a}, h + 1, char_length({a}) - h - t), 'b', substring({b}, h + 1, char_length({b}) - h - t))"
    return F.expr(_let(least, "n", _let(head, "h", _let(tail, "t", _let(middle, "m", near)))))


def _counts(line: str, signs: str) -> str:
    """Counts of the signs (mod 16), eight bits each, so coded that counts differ by at least as much as their bits.

    Sixteen eight-bit words in a ring, neighbours one bit apart: ones come in
    from the right until all are set, then they leave from the right.
    """
    count = lambda c: f"(char_length({line}) - char_length(replace({line}, '{c}', ''))) % 16"
    code = "if(c <= 8, shiftleft(1, c) - 1, 255 & ~(shiftleft(1, c - 8) - 1))"
    return " | ".join(f"shiftleft(cast({_let(count(x), 'c', code)} as bigint), {8 * i})" for i, x in enumerate(signs))


def _bits(a: str, b: str) -> str:
    return " + ".join(f"bit_count({a}.{c} ^ {b}.{c})" for c in COUNTS)


def _near(a: str, b: str, levels: Levels) -> str:
    """Whether two lines (struct of n and counts) may be near each other: an edit changes two counts by one at most."""
    most = allowed(f"least({a}.n, {b}.n)", levels)
    return f"abs({a}.n - {b}.n) <= {most} and {_bits(a, b)} <= 2 * {most}"


def lines_of(df: DataFrame) -> DataFrame:
    """doc, doc_text, place, line and its hashes h1, h2, for every line with a word of (doc_id, text)."""
    rows = df.where("text is not null").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("doc_text"), F.posexplode(F.split("text", "\n")).alias("place", "line"))
    worded = rows.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return worded.select("*", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def occurrences(df: DataFrame, levels: Levels) -> DataFrame:
    """Every line of (doc_id, text) as hashes only, a row for each of its entries, written once to the shared folder.

    ``entry`` numbers a line's entries: its index entries (``own``), then the
    others that it probes. A line below the first level is one row without a key.
    Places come from a table by length, and each is a row before its key is
    made: keys inside array functions are not compiled, which costs several times
    as much. Where all characters are bytes, a segment is cut from the bytes
    (the same key, and no count of characters from the line's start).
    """
    least = min(x for x, _ in levels)
    spot = "transform({0}, p -> struct(p.m as m, p.i as i, p.at as at, p.size as size, {1} as own))"
    spots = F.expr(f"concat({spot.format(index_places(levels), 'true')}, {spot.format(probe_places(levels), 'false')})")
    places = df.sparkSession.range(least, TABLED + 1).select(F.col("id").cast("int").alias("n")).select("n", spots.alias("spots"))
    lines = lines_of(df).withColumn("n", F.char_length("line")).join(F.broadcast(places), "n", "left")  # TABLED rows
    lines = lines.withColumns({"spots": F.when(F.col("n") >= least, F.coalesce("spots", spots)), "raw": F.col("line").cast("binary"), "bytes": F.octet_length("line") == F.col("n")})
    held = ("doc", "doc_text", "place", "h1", "h2")
    each = lines.select(*held, "line", "raw", "bytes", F.posexplode_outer("spots").alias("entry", "p"))
    key = "if(bytes, xxhash64(p.m, p.i, substring(raw, p.at, p.size)), xxhash64(p.m, p.i, substring(line, p.at, p.size)))"
    path = run_dir(df.sparkSession, "lines")
    each.select(*held, F.coalesce("entry", F.lit(0)).alias("entry"), F.col("p.own").alias("own"), F.expr(f"if(p is null, null, {key})").alias("key")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _few(df: DataFrame) -> DataFrame:
    """Broadcast a side only if its row count allows."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def _near_enough(texts: DataFrame, pairs: DataFrame, levels: Levels) -> DataFrame:
    """h1 of the later line of each pair (later, earlier) that is near enough."""
    line = texts.select("h1", "line")
    both = pairs.join(line.withColumnsRenamed({"h1": "later", "line": "x"}), "later").join(line.withColumnsRenamed({"h1": "earlier", "line": "y"}), "earlier")
    both = both.withColumn("most", F.expr(allowed("least(char_length(x), char_length(y))", levels)))
    near = F.lit(False)
    for k in sorted({k for _, k in levels}):
        near = near | ((F.col("most") == k) & reaches("x", "y", k) & within("x", "y", k))
    return both.where(near).select(F.col("later").alias("h1")).distinct()


def _verified(texts: DataFrame, pairs: DataFrame, levels: Levels) -> DataFrame:
    """h1 of every line with a partner (later, earlier, gap) that is near enough.

    One partner suffices, so each line is compared with its likeliest first (the
    least gap), and only lines that fail there with their others.
    """
    pairs = cut(pairs.groupBy("later", "earlier").agg(F.min("gap").alias("gap")))
    best = cut(pairs.groupBy("later").agg(F.min(F.struct("gap", "earlier")).alias("best")).select("later", F.col("best.earlier").alias("earlier")))
    first = cut(_near_enough(texts, best, levels))
    rest = pairs.select("later", "earlier").join(best, ["later", "earlier"], "left_anti").join(first.select(F.col("h1").alias("later")), "later", "left_anti")
    return first.union(_near_enough(texts, rest, levels))


def _pairs(joined: DataFrame) -> DataFrame:
    """(later, earlier, gap) of joined lines a and b."""
    gap = F.expr(f"{_bits('a', 'b')} + abs(a.n - b.n)")
    return joined.select(F.expr("if(a.at < b.at, b.at.h1, a.at.h1) as later"), F.expr("if(a.at < b.at, a.at.h1, b.at.h1) as earlier"), gap.alias("gap"))


def _meet(levels: Levels) -> Column:
    """Different lines a and b that may be near each other, the later one still open."""
    return F.expr(f"a.key = b.key and a.at.h1 <> b.at.h1 and if(a.at < b.at, b.open, a.open) and {_near('a', 'b', levels)}")


def _opened(lines: DataFrame, gone: DataFrame) -> DataFrame:
    """The lines with ``open``: not yet known to go."""
    flag = gone.select(F.col("h1").alias("gone_h1"), F.lit(True).alias("gone"))
    return lines.join(_few(flag), F.col("at.h1") == F.col("gone_h1"), "left").withColumn("open", F.col("gone").isNull()).drop("gone", "gone_h1")


def _fine_pairs(lines: DataFrame, levels: Levels) -> DataFrame:
    """Pairs of lines (at, n, line, counts, open, indexed) by the t + 1 rarest finer segments of the shorter one.

    Of t + 1 segments in order, one (the i-th, from 0) is met with just i edits
    before it and t - i at most after it, which bounds its shift.
    """
    own = ("at", "n", *COUNTS, "open")
    most = f"{allowed('n', levels)} + 1"
    keyed = fine_index(lines.where("indexed").select("at", "n", "line"), levels)
    often = cut(keyed.groupBy("key").agg(F.count("*").alias("often"), F.min(F.struct("at", "n", "j")).alias("one")))
    # a segment that one line has alone knows its line; only lines without enough of them look up how often each of theirs occurs
    alone = often.where("often = 1").groupBy("one.at", "one.n").agg(F.collect_list(F.struct("one.j", "key")).alias("keys"))
    alone = cut(alone.where(f"size(keys) >= {most}"))
    rest = keyed.join(_few(alone.select("at")), "at", "left_anti").join(often.select("key", "often"), "key")
    rated = rest.groupBy("at", "n").agg(F.sort_array(F.collect_list(F.struct("often", "j", "key"))).alias("keys"))  # size(line) / FINE or so
    rated = rated.select("at", "n", F.expr("transform(keys, x -> struct(x.j as j, x.key as key))").alias("keys"))
    rarest = F.expr(f"array_sort(slice(keys, 1, {most}))")
    index = alone.union(rated).select("at", F.posexplode(rarest).alias("i", "x")).join(lines.select(*own), "at")
    index = cut(index.select("x.key", "i", *own))
    probes = fine_probe(lines.select(*own, "line"), levels)
    shift = F.expr(f"a.n <= b.n and abs(b.s) <= a.i and abs(b.n - a.n - b.s) <= {allowed('a.n', levels)} - a.i")
    return _pairs(probes.alias("b").join(_few(index.alias("a")), _meet(levels) & shift))


def near_lines(df: DataFrame, rows: DataFrame, levels: Levels = LEVELS) -> DataFrame:
    """h1 of every line with an earlier, different line near it, of the lines of df whose ``occurrences`` are ``rows``."""
    entries = rows.where("key is not null").select("h1", F.struct("doc", "place").alias("at"), "key", "own")
    # entries that different lines meet in; all others end here
    shared = entries.groupBy("key").agg(F.min("h1").alias("lo"), F.max("h1").alias("hi"), F.max("own").alias("own")).where("lo <> hi and own").select("key")
    shared = cut(shared)
    met = cut(entries.join(_few(shared), "key", "left_semi").groupBy("key", "own", "h1").agg(F.min("at").alias("at")))
    wanted = cut(met.select("h1").distinct())
    texts = lines_of(df).select("h1", "h2", "line").join(_few(wanted), "h1").groupBy("h1", "h2").agg(F.min("line").alias("line"))
    texts = cut(texts.select("h1", "line", F.char_length("line").alias("n"), *[F.expr(_counts("line", x)).alias(c) for c, x in zip(COUNTS, SIGNS, strict=True)]))
    own = ("n", *COUNTS)
    met = cut(met.join(texts.select("h1", *own), "h1").select("key", "own", *own, F.struct("at.doc", "at.place", "h1").alias("at")))
    # 1: each line against the earliest line of each of its own entries
    index = met.where("own").alias("a")
    earliest = cut(met.where("own").groupBy("key").agg(F.min(F.struct("at", *own)).alias("b"))).select("key", "b.*")
    close = F.expr("a.key = b.key and a.at <> b.at and " + _near("a", "b", levels))
    pairs = _pairs(index.join(earliest.alias("b"), close))
    gone = cut(_verified(texts, pairs, levels))
    crowded = cut(met.groupBy("key").agg(F.count("*").alias("held")).where(F.col("held") > CROWD).select("key", F.lit(True).alias("crowded")))
    packed = cut(met.join(_few(crowded.select("key")), "key", "left_semi").select("key", *own, "at"))
    # 2: open lines of crowded entries against the earliest ones, and against the earliest open ones
    earliest = Window.partitionBy("key").orderBy("at")
    for turn in range(ROUNDS):
        opened = _opened(packed, gone)
        pivots = (opened.where("open") if turn else opened).withColumn("rank", F.row_number().over(earliest)).where(F.col("rank") <= PIVOTS).drop("rank")
        met_pivot = F.expr(f"a.key = b.key and a.open and b.at < a.at and {_near('a', 'b', levels)}")
        gone = cut(gone.union(_verified(texts, _pairs(opened.alias("a").join(cut(pivots).alias("b"), met_pivot)), levels)).distinct())
    # 3: lines still open against all entries that they probe, or that probe them, where these are not crowded
    opened = cut(_opened(met, gone).select("key", "own", *own, "at", "open").join(_few(crowded), "key", "left"))
    few = opened.where("crowded is null")
    pairs = _pairs(few.where("own").alias("a").join(few.alias("b"), _meet(levels)))
    # 4: lines of crowded entries by finer keys
    rest = opened.where("crowded").groupBy("at", *own, "open").agg(F.max("own").alias("indexed"))
    rest = cut(rest.withColumn("h1", F.col("at.h1")).join(texts.select("h1", "line"), "h1").drop("h1"))
    if not rest.isEmpty():
        pairs = pairs.union(_fine_pairs(rest, levels))
    return gone.union(_verified(texts, pairs, levels)).distinct()


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int | None = None, min_chars: int | None = None, levels: Levels = LEVELS) -> DataFrame:
    """The input rows as ``row``, with n_lines (with a word), n_removed and the text that is left.

    ``threshold`` and ``min_chars`` allow the same edits at every length, instead of ``levels``.
    """
    if threshold is not None:
        levels = ((min(x for x, _ in LEVELS) if min_chars is None else min_chars, threshold),)
    if any(least <= k for least, k in levels):
        raise ValueError("a line must be longer than the edits allowed")
    texts = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    entries = occurrences(texts, levels)
    lines = entries.where("entry = 0").select("doc", "doc_text", "place", "h1", "h2")
    place = F.struct("doc", "place")
    groups = lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    near = cut(near_lines(texts, entries, levels)).withColumn("near", F.lit(True))
    marked = groups.join(near, "h1", "left").where("near or first <> last").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near"))
    marked = cut(marked)  # so that the join can split a line that very many documents share
    hits = lines.select("h1", "h2", "doc", "doc_text", "place").join(marked, ["h1", "h2"]).where(F.col("near") | (F.struct("doc", "place") != F.col("first")))
    removed = cut(hits.groupBy("doc", "doc_text").agg(F.collect_set("place").alias("removed")))
    total = removed.agg(F.sum(F.size("removed"))).first()[0] or 0
    removed = F.broadcast(removed) if total <= BROADCAST else removed  # by all of its entries
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("doc"), F.col(text_col).cast("string").alias("text")).withColumn("doc_text", F.xxhash64("text"))
    out = rows.join(removed, ["doc", "doc_text"], "left").withColumn("cells", F.split("text", "\n"))
    left = F.expr("array_join(transform(array_except(sequence(0, size(cells) - 1), removed), i -> get(cells, i)), '\n')")
    return out.select(
        "row", F.coalesce(F.expr(r"cast(size(filter(cells, x -> x rlike '[^\\x20\\x09-\\x0D]')) as bigint)"), F.lit(0).cast("bigint")).alias("n_lines"),
        F.coalesce(F.expr("cast(size(removed) as bigint)"), F.lit(0).cast("bigint")).alias("n_removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(left).alias("text_left"),
    )


#: The same rows by the distance of all lines of nearly equal length.
SQL = r"""
WITH l AS (
  SELECT doc_id, place - 1 AS place, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents)),
w AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
g AS (SELECT line, length(line) AS n, min((doc_id, place)) AS first FROM w GROUP BY line),
h AS (SELECT *, CASE WHEN n >= 512 THEN 3 WHEN n >= 64 THEN 2 ELSE 1 END AS most FROM g WHERE n >= 24),
d AS (SELECT unnest([0, 1, 2, 3]) AS d),
p AS (
  SELECT a.line AS x, b.line AS y, a.first AS fx, b.first AS fy, a.most
  FROM h a JOIN d ON d.d <= a.most JOIN h b ON b.n = a.n + d.d AND a.line <> b.line),
near AS (SELECT DISTINCT CASE WHEN fx < fy THEN y ELSE x END AS line FROM p WHERE levenshtein(x, y) <= most),
m AS (
  SELECT l.doc_id, l.place, l.line, w.line IS NOT NULL AS worded,
         w.line IS NOT NULL AND ((l.doc_id, l.place) <> g.first OR near.line IS NOT NULL) AS gone
  FROM l LEFT JOIN w ON l.doc_id = w.doc_id AND l.place = w.place LEFT JOIN g ON w.line = g.line LEFT JOIN near ON w.line = near.line)
SELECT doc_id, count(*) FILTER (WHERE worded) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text
FROM m GROUP BY doc_id
"""
