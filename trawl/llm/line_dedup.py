"""Line deduplication by a segment-partition edit join (native).

Two lines are near copies when few single-character edits (insertions,
deletions, substitutions of code points) turn one into the other: one edit for
every ``per_edit`` code points of the shorter line, ``max_edits`` at most.  So
short lines are compared for equality only, by rule: one changed character
makes another word or number of them.  A line split into k + 1 segments keeps at
least one of them whole under k edits, so every line is indexed under its own
segments (edits, length, segment number, substring) and probes the segments that a
line of its own or a shorter length could have, at the few positions to which
that many edits can move them.  Lines that meet under a key are verified by
a banded bit-parallel edit distance.

Keys that only one line has (nearly all) are dropped by an aggregation of
(key, smallest line, largest line) before any line text moves.  The lines of
a key are dealt into blocks, and every pair of blocks is compared in one
row, so no key becomes one task and no candidate pair becomes a row.

Of equal lines the occurrence with the smallest (doc_id, position) stays.
A different line goes only if it is a near copy of one that stays: in the
order of first occurrence a line stays unless it is linked to an earlier one
that stays.  This is decided in rounds over the links alone; after ``ROUNDS``
rounds a chain of lines still open is decided in the order of their hashes, which
ends it soon and keeps the rule.  Blank lines are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.plan import compute_once
from trawl.llm.common import Scratch, broadcast_checked, fresh

PER_EDIT = 16  # code points of the shorter line for each edit
ROUNDS = 12


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, inside a lambda body."""
    return F.get(F.transform(F.array(value), fn), 0)


def banded_distance(a: Column, b: Column, k: int) -> Column:
    """Edit distance of two arrays of characters where it is at most ``k``; some larger number elsewhere.

    One bit per row of a band around the diagonal, kept in one bigint;
    column ``j`` sees the rows up to ``j + k`` (the highest bit).  The lengths
    must exceed ``k`` and differ by ``k`` or less.  ``a`` and ``b`` must be
    lambda variables or columns, not expressions.
    """
    width = 4 * k + 4
    ones = (1 << width) - 1
    top = width - 1
    m, n = F.size(a), F.size(b)

    def bit(x, at):
        return F.shiftright(x, at).bitwiseAND(F.lit(1))

    def flip(x):
        return x.bitwiseXOR(F.lit(ones))

    def step(acc, j):
        char = F.get(b, j - 1)
        match = F.lit(0)
        for t in range(2 * k + 1):
            match = match + F.when((j + k - t >= 1) & (F.get(a, F.greatest(j + (k - t - 1), F.lit(0))) == char),
                                   F.lit(1 << (top - t))).otherwise(F.lit(0))

        def row(pm):
            carry = (pm.bitwiseAND(acc["vp"]) + acc["vp"]).bitwiseXOR(acc["vp"])
            d0 = carry.bitwiseOR(pm).bitwiseOR(acc["vn"]).bitwiseAND(F.lit(ones))

            def rest(d0):
                hp = acc["vn"].bitwiseOR(flip(d0.bitwiseOR(acc["vp"])))
                hn = d0.bitwiseAND(acc["vp"])
                down = F.shiftright(d0, 1)
                at = (F.lit(top) - (j + k - m)).cast("int")
                dist = acc["dist"] + F.when(j + k <= m, F.when(bit(d0, top) == 0, 1).otherwise(0)).otherwise(
                    (F.shiftright(hp, 0).bitwiseAND(F.element_at(powers, at + 1)) != 0).cast("int")
                    - (hn.bitwiseAND(F.element_at(powers, at + 1)) != 0).cast("int"))
                return F.struct(hn.bitwiseOR(flip(down.bitwiseOR(hp))).alias("vp"),
                                down.bitwiseAND(hp).alias("vn"), dist.alias("dist"))

            return _let(d0, rest)

        return F.when(acc["dist"] > 3 * k, acc).otherwise(_let(match.cast("long"), row))

    powers = F.array(*[F.lit(1 << i).cast("long") for i in range(width)])
    first = F.struct(F.lit(ones - ((1 << (top - k)) - 1)).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"),
                     F.lit(k).alias("dist"))
    return F.aggregate(F.sequence(F.lit(1), n), first, step, lambda acc: acc["dist"])


def segment_slots(k: int) -> list[tuple[int, int, int]]:
    """(difference of lengths, segment, offset) of the keys of a line under ``k`` edits.

    Offsets are those a segment can be moved by: at most the edits to its
    left, and such that the edits to its right can still make up the
    difference of the lengths.
    """
    return [(diff, i, off) for diff in range(k + 1) for i in range(k + 1)
            for off in range(max(-i, diff - (k - i)), min(i, diff + (k - i)) + 1)]


def segment_keys(lines: DataFrame, max_edits: int, per_edit: int) -> DataFrame:
    """(id, line, key, home) of ``lines`` (id, line, n characters): index keys (home) and probe keys.

    The shorter line of a pair with k edits, fewer than ``max_edits``, has from ``k * per_edit`` code
    points to one less than the next number's range, the longer one up to k more; a line has the
    keys of every number of edits it can be in a pair with.  Lines are first dealt to the slots, a fixed
    table, and each row makes one key: the code stays small enough to be compiled, which that of all slots at once is not.
    """
    slots = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(("k", "diff", "i", "off"), (k, *slot))])
                      for k in range(1, max_edits + 1) for slot in segment_slots(k)])
    k, diff, i, off = (F.col(f"s.{c}") for c in ("k", "diff", "i", "off"))
    dealt = lines.select("id", "line", "n", F.explode(slots).alias("s")).where(
        (F.col("n") >= k * per_edit) & ((k == max_edits) | (F.col("n") < (k + 1) * per_edit + k)))
    size = F.col("n") - diff  # length of the indexed line
    start, stop = (F.call_function("div", size * j, k + 1).cast("int") for j in (i, i + 1))
    key = F.xxhash64((size * (max_edits + 1) + i) * (max_edits + 1) + k, F.substring("line", start + 1 + off, stop - start))
    return dealt.select("id", "line", key.alias("key"), ((diff == 0) & (off == 0)).alias("home"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, pos, line, id, id2): every line that is not blank."""
    lines = docs.where(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("doc_hash"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    return lines.select("*", F.xxhash64("line").alias("id"), F.xxhash64(F.lit("2"), "line").alias("id2"))


# Character sets whose counts are compared before the edit distance; any sets give a valid bound.
BAGS = ("a", "bcd", "e", "fgh", "i", "jkl", "mn", "o", "pqr", "s", "t", "uvw", "xyz", " ", ".,;:!?", "0123456789")


def bag(line: Column) -> Column:
    """How many characters of each set a line has."""
    return F.array(*[F.length(line) - F.length(F.translate(line, c, "")) for c in BAGS])


def bags_near(a: Column, b: Column, k: int) -> Column:
    """Whether counts allow ``k`` edits: an edit adds one and removes one character at most."""
    def surplus(p, q):
        return F.aggregate(F.zip_with(p, q, lambda x, y: F.greatest(x - y, F.lit(0))), F.lit(0), lambda s, x: s + x)

    return (surplus(a, b) <= k) & (surplus(b, a) <= k)


def parity(counts: Column) -> Column:
    """One bit a count, set where it is odd: an edit turns two bits at most."""
    return F.aggregate(counts, F.lit(0), lambda acc, n: acc * 2 + n % 2)


# Step widths of the search for a common start or end; lines beyond twice the first are trimmed less, never compared less.
STEPS = [1 << i for i in range(20, -1, -1)]


def trimmed_distance(x: Column, y: Column, k: int) -> Column:
    """``banded_distance`` of two lines (structs of line, c) without their common start and end.

    At least ``k + 1`` characters of either stay, so that the band fits; a
    common start or end never changes the distance.
    """
    def grow(limit, part):
        return F.aggregate(F.array(*[F.lit(w) for w in STEPS]), F.lit(0), lambda acc, w: F.when(
            (acc + w <= limit) & (part(x, acc, w) == part(y, acc, w)), acc + w).otherwise(acc))

    def start(z, done, width):
        return F.substring(z["line"], done + 1, width)

    def end(z, done, width):
        return F.substring(z["line"], F.size(z["c"]) - done - width + 1, width)

    def middle(z, p, q):
        return F.slice(z["c"], p + 1, F.size(z["c"]) - p - q)

    room = F.least(F.size(x["c"]), F.size(y["c"])) - (k + 1)
    return _let(grow(room, start), lambda p: _let(grow(room - p, end), lambda q: _let(
        F.struct(middle(x, p, q).alias("a"), middle(y, p, q).alias("b")),
        lambda z: _let(z["a"], lambda a: _let(z["b"], lambda b: banded_distance(a, b, k))))))


def near_lines(lines: DataFrame, scratch: Scratch, max_edits: int, per_edit: int = PER_EDIT, block: int = 32) -> DataFrame:
    """Links (a, b) between the ids of different lines that are near copies.

    ``lines`` has (id, line), repeats allowed.  Every pair is a link whose distance is
    at most ``max_edits`` and one for each ``per_edit`` code points of the shorter line;
    ``per_edit`` is at least ``2 * max_edits + 2``, so that segments and band fit.
    """
    if per_edit < 2 * max_edits + 2:
        raise ValueError("per_edit is too small for the band")
    n = F.char_length("line")
    long = lines.select("id", "line", n.alias("n")).where(F.col("n") >= per_edit)
    keyed = segment_keys(long, max_edits, per_edit)
    shared = keyed.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.max("home").alias("home"))
    shared = scratch.keep(shared.where("a <> b AND home").select("key"), "keys")
    # a line has a few dozen keys at most, so the sets of an id are bounded; counts of characters are taken once a line
    members = keyed.join(broadcast_checked(shared), "key", "left_semi").groupBy("id").agg(
        F.first("line").alias("line"), F.collect_set("key").alias("keys"),
        F.collect_set(F.when(F.col("home"), F.col("key"))).alias("homes")).withColumn("bag", bag(F.col("line")))
    members = members.select("id", "line", "keys", "homes", "bag", parity(F.col("bag")).alias("odd"),
                             F.explode("keys").alias("key"))
    members = scratch.keep(members, "members")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / block).cast("int")
    m = members.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    m = m.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    item = F.struct("id", "own", "line", "keys", "homes", F.array_contains("homes", F.col("key")).alias("home"), "bag", "odd",
                    F.split("line", "").alias("c"))
    m = m.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    # dealt by pair of blocks: the join above leaves a key's rows together
    groups = m.repartition("key", "i", "j").groupBy("key", "i", "j").agg(F.collect_list(item).alias("g"))
    groups = compute_once(groups, ["key", "i", "j"], g=F.col("g")).where(F.size("g") > 1)
    pairs = groups.select("key", "i", "j", "g", F.posexplode("g").alias("at", "x"))

    def allowed(y):
        shorter = F.least(F.size(F.col("x.c")), F.size(y["c"]))
        return F.least(F.call_function("div", shorter, F.lit(per_edit)).cast("int"), F.lit(max_edits))

    def meet(y):
        """Cheap bounds first; a pair is compared under one key only, the least that is a segment of one and a probe of the other."""
        x = F.col("x")
        met = F.array_union(F.array_intersect(x["homes"], y["keys"]), F.array_intersect(x["keys"], y["homes"]))
        return ((y["id"] != x["id"]) & ((F.col("i") == F.col("j")) | (y["own"] != x["own"])) & (x["home"] | y["home"])
                & (F.abs(F.size(y["c"]) - F.size(x["c"])) <= allowed(y))
                & (F.bit_count(x["odd"].bitwiseXOR(y["odd"])) <= 2 * max_edits)
                & bags_near(x["bag"], y["bag"], max_edits) & (F.array_min(met) == F.col("key")))

    rest = F.slice("g", F.col("at") + 2, F.greatest(F.size("g") - F.col("at") - 1, F.lit(0)))
    pairs = pairs.select(F.col("x.id").alias("a"), "x", F.filter(rest, meet).alias("ys")).where(F.size("ys") > 0)
    near = F.filter("ys", lambda y: trimmed_distance(F.col("x"), y, max_edits) <= allowed(y))
    links = pairs.select("a", F.explode(near).alias("y")).select("a", F.col("y.id").alias("b"))
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def copies_to_remove(edges: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(id) of the nodes to remove, from directed links (u, v), v the earlier of two near copies.

    Every removed node has a link to one that stays, and no two that stay are linked.
    A node without an earlier open neighbour stays; its later neighbours go.
    """
    gone, step = None, 0
    edges = scratch.keep(edges.distinct(), "open-0")
    while edges.count():
        stay = edges.select(F.col("v").alias("id")).distinct().join(edges.select(F.col("u").alias("id")), "id", "left_anti")
        hit = edges.join(stay.withColumnRenamed("id", "v"), "v", "left_semi").select(F.col("u").alias("id")).distinct()
        hit = scratch.keep(hit, f"gone-{step}")
        gone = hit if gone is None else gone.unionByName(hit)
        # what stays has lost its later neighbours, so only the nodes that go need to be taken out
        for end in ("u", "v"):
            edges = edges.join(hit.withColumnRenamed("id", end), end, "left_anti")
        step += 1
        if step == rounds:
            first, second = F.struct(F.xxhash64("u"), "u"), F.struct(F.xxhash64("v"), "v")
            edges = edges.select(F.when(first > second, F.col("u")).otherwise(F.col("v")).alias("u"),
                                 F.when(first > second, F.col("v")).otherwise(F.col("u")).alias("v"))
        edges = scratch.keep(edges, f"open-{step}")
    return edges.select(F.col("u").alias("id")) if gone is None else gone


def dedup_lines(docs: DataFrame, max_edits: int = 2, per_edit: int = PER_EDIT) -> DataFrame:
    """``docs`` with repeated and nearly repeated lines removed.

    Adds n_lines (all lines of the text), n_removed and n_links (links of the
    document's lines to different lines) and replaces ``text``; the other
    columns stay, except one that already has such a name, which is replaced.
    A null text stays null and has no lines; an empty text is one blank line;
    a text may end up empty.  Rows that repeat a doc_id and text are one
    document and are cleaned alike.  A null doc_id comes first.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    lines = occurrences(docs)
    links = scratch.keep(near_lines(lines.select("id", "line"), scratch, max_edits, per_edit), "links")
    degree = scratch.keep(links.select("a").unionByName(links.select(F.col("b").alias("a"))).groupBy(F.col("a").alias("id")).agg(
        F.count(F.lit(1)).alias("n_links")), "degree")
    occ = scratch.keep(lines.drop("line").join(broadcast_checked(degree), "id", "left").select(
        "doc_id", "doc_hash", "pos", "id", "id2", "n_links"), "occurrences")
    place = F.struct("doc_id", "doc_hash", "pos")
    places = occ.where("n_links > 0").groupBy("id").agg(F.min(place).alias("p"))
    ends = links.join(places.withColumnsRenamed({"id": "a", "p": "pa"}), "a").join(
        places.withColumnsRenamed({"id": "b", "p": "pb"}), "b")
    later = F.col("pa") > F.col("pb")
    copies = copies_to_remove(ends.select(F.when(later, F.col("a")).otherwise(F.col("b")).alias("u"),
                                          F.when(later, F.col("b")).otherwise(F.col("a")).alias("v")), scratch)
    copies = broadcast_checked(scratch.keep(copies, "copies"))
    equal = occ.join(copies, "id", "left_anti")
    classes = equal.groupBy("id", "id2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = equal.join(classes, ["id", "id2"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "doc_hash", "pos")
    gone = gone.unionByName(occ.join(copies, "id", "left_semi").select("doc_id", "doc_hash", "pos"))
    linked = occ.where("n_links > 0").groupBy("doc_id", "doc_hash").agg(F.sum("n_links").alias("n_links"))
    per_doc = gone.groupBy("doc_id", "doc_hash").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    per_doc = per_doc.withColumn("n_links", F.lit(0).cast("long")).unionByName(
        linked.withColumn("gone", F.array().cast("array<int>"))).groupBy("doc_id", "doc_hash").agg(
        F.flatten(F.collect_list("gone")).alias("gone"), F.sum("n_links").alias("links"))
    key, mark, cut, links_of = (fresh(c, docs) for c in ("_doc", "_hash", "_gone", "_links"))
    per_doc = per_doc.select(F.col("doc_id").alias(key), F.col("doc_hash").alias(mark), F.col("gone").alias(cut),
                             F.col("links").alias(links_of))
    added = ("n_lines", "n_removed", "n_links")
    out = docs.join(per_doc, docs["doc_id"].eqNullSafe(F.col(key)) & (F.xxhash64("text") == F.col(mark)), "left")
    gap = F.transform(cut, lambda p, i: F.concat(F.repeat(F.lit("0"), (
        p - F.when(i == 0, F.lit(0)).otherwise(F.get(cut, F.greatest(i - 1, F.lit(0))) + 1)).cast("int")), F.lit("1")))
    flags = F.split(F.array_join(gap, ""), "")
    kept = F.filter(F.arrays_zip(F.split("text", "\n").alias("line"), flags.alias("flag")),
                    lambda z: (F.coalesce(z["flag"], F.lit("0")) != "1") & z["line"].isNotNull())
    text = F.when(F.size(cut) > 0, F.array_join(F.transform(kept, lambda z: z["line"]), "\n")).otherwise(F.col("text"))
    return out.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns if c not in added],
                      F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
                      F.coalesce(F.size(cut), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(links_of, F.lit(0)).alias("n_links"))
