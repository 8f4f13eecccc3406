"""Variant spellings of names: canonical rewritings, exploded and equi-joined, scored by rarity.

Every distinct spelling is read in all ways that the rules of ``name_forms`` allow.  Then:

1. *Order.*  Of a spelling's readings the one is taken whose (given, surname) other spellings share, else the one that fits
   the roles in which its outer words stand elsewhere in the corpus.
2. *Keys.*  A key is a (given, surname) pair.  Parts of keys meet by an equi-join on exploded forms: one letter dropped (two
   parts within one edit share such a form).  A pair of parts counts only if it is rare: one of them occurs in few keys, or in
   far fewer than the other.  Keys then meet by an equi-join on the rewritten key, or on the whole name written as one word.
   Each key is tied to the best-supported of the keys that pass, never to all of them, and not if middle names differ.
3. *Initials.*  A spelling with an initial joins the keys with that initial and surname.  Its middle name or initial must agree.

The score of a rewriting is its *rarity*: of all that the rewriting admits (better keys, weighted by their spellings; entities
with an initial), the share of what it leads to.  Only a rewriting with a rarity above ``DECIDES`` links.

Links form stars, so an entity is found by following parents (pointer doubling); nothing is collected to the driver, and pairs
are made only of parts of one form, once for all names that have them, until the result itself is pairs.

Defined cases: null, blank and placeholder names have no entity; a spelling that can't be read in two words is linked only
to spellings that are the same as one word; repeated rows count once; empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.name_forms import joined, parse_name
from decisionlake.session import cut

#: A part of a key that occurs in at most so many keys is rare enough to be a slip.
RARE = 2
#: So is one that occurs in so many times fewer keys than the part beside which it may be a slip.
RARER = 5
#: A rewriting decides if more than this share of what it admits is the one that it leads to.
DECIDES = 0.5
#: Most rounds of pointer doubling; a chain of 2^ROUNDS ties would be needed to outrun it, and that is checked.
ROUNDS = 12

_READ = "name string, words array<string>, readings array<struct<given:string,middle:string,surname:string,cost:int,written:string>>"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        names = batch["name"].tolist()
        readings = [[r._asdict() for r in parse_name(n)] for n in names]
        out = pd.DataFrame({"name": names, "words": [joined(n) for n in names], "readings": readings})
        yield out[out["words"].map(len) > 0]


def one_letter_less(token: str) -> Column:
    """The token and all that is left of it when one letter goes: two tokens within one edit share such a form."""
    t = F.col(token)
    less = F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    return F.array_distinct(F.concat(F.array(t), less))


def near(a: Column, b: Column) -> Column:
    """Within one edit, a swap of neighbours included."""
    d = F.levenshtein(a, b, 2)  # -1 beyond two
    letters = lambda c: F.array_sort(F.split(c, ""))
    return d.between(0, 1) | ((d == 2) & (F.length(a) == F.length(b)) & (letters(a) == letters(b)))


def spellings(*columns: DataFrame) -> DataFrame:
    """``name, words, readings``: the distinct spellings of one-column frames that are names, read."""
    names = columns[0].toDF("name")
    for other in columns[1:]:
        names = names.unionByName(other.toDF("name"))
    return names.where("name IS NOT NULL").distinct().mapInPandas(_read, _READ)


def _ordered(read: DataFrame) -> DataFrame:
    """``name, words, given, middle, surname, written``: one reading of each spelling that has any."""
    natural = read.where(F.size("readings") > 0).select("name", "words", "readings", F.col("readings")[0].alias("n"))
    full = natural.where(F.length("n.given") > 1)
    support = full.groupBy(F.col("n.given").alias("given"), F.col("n.surname").alias("surname")).agg(F.count("*").alias("support"))
    first = natural.groupBy(F.col("n.given").alias("token")).agg(F.count("*").alias("f"))
    last = natural.groupBy(F.col("n.surname").alias("token")).agg(F.count("*").alias("l"))
    role = first.join(last, "token", "full").select("token", F.when(F.length("token") > 1, F.log((F.coalesce("f", F.lit(0)) + 1) / (F.coalesce("l", F.lit(0)) + 1))).otherwise(9.0).alias("role"))

    sure = natural.where(~F.exists("readings", lambda r: r["surname"] != F.col("n.surname")))
    doubtful = natural.join(sure.select("name"), "name", "left_anti")
    each = doubtful.select("name", "words", F.col("n.given").alias("a"), F.col("n.surname").alias("z"), F.posexplode("readings").alias("at", "r")).select("name", "words", "a", "z", "at", "r.*")
    each = each.join(support, ["given", "surname"], "left")
    each = each.join(role.select(F.col("token").alias("a"), F.col("role").alias("ra")), "a", "left").join(role.select(F.col("token").alias("z"), F.col("role").alias("rz")), "z", "left")
    is_natural = F.col("surname") == F.col("z")
    others = F.coalesce("support", F.lit(0)) - F.when((F.col("at") == 0) & (F.length("given") > 1), 1).otherwise(0)
    score = F.struct(
        F.when(others > 0, 1).otherwise(0).alias("shared"),
        F.when(is_natural == (F.coalesce("ra", F.lit(9.0)) >= F.coalesce("rz", F.lit(9.0))), 1).otherwise(0).alias("fits"),
        others.alias("others"),
        (-F.col("at")).alias("first"),
    )
    # where both orders are shared, the roles decide
    best = each.groupBy("name", "words").agg(F.max_by(F.struct("given", "middle", "surname", "written"), score).alias("r"))
    return sure.select("name", "words", "n.given", "n.middle", "n.surname", "n.written").unionByName(best.select("name", "words", "r.*"))


def _keys(ordered: DataFrame) -> DataFrame:
    """``key, given, surname, n, middle, given_w``: the (given, surname) pairs with their spellings' number and commonest middle name."""
    middles = ordered.where(F.length("given") > 1).groupBy("given", "surname", "middle").agg(F.count("*").alias("n"), F.max("written").alias("written"))
    known = F.when(F.length("middle") > 1, F.struct("n", "middle"))
    keys = middles.groupBy("given", "surname").agg(F.sum("n").alias("n"), F.max(known)["middle"].alias("middle"), F.max(F.struct("n", "written"))["written"].alias("written"))
    return keys.select(F.concat_ws("|", "given", "surname").alias("key"), "given", "surname", "n", "middle", F.split("written", r"\|")[0].alias("given_w"))


def _slips(parts: DataFrame) -> DataFrame:
    """``part, other, rare, top``: parts of names one of which may be a slip of the other; whether few keys have ``other``, and
    the most spellings that one of these has.

    parts: ``part, written, breadth, top``, every way in which a part is written, in how many keys it stands, and the most
    spellings of one of these.  Two parts meet by
    an equi-join on what is left when a letter goes, in sound or as written; one of them must be rare, or far rarer than the
    other.  This is done once for each pair of parts, however many names have them.
    """
    read = [parts.select("part", F.col("part").alias("text"), "breadth", "top").distinct(), parts.where("written <> part").select("part", F.col("written").alias("text"), "breadth", "top")]
    forms = read[0].unionByName(read[1]).select("part", "text", "breadth", "top", F.explode(one_letter_less("text")).alias("form"))
    # hashes are what travels; whether two texts are near is seen when they have met
    forms = forms.select(F.xxhash64("form").alias("form"), "part", "text", "breadth", "top")
    other = forms.select("form", F.col("part").alias("other"), F.col("text").alias("other_text"), F.col("breadth").alias("other_breadth"), F.col("top").alias("other_top"))
    few, many = F.least("breadth", "other_breadth"), F.greatest("breadth", "other_breadth")
    met = forms.join(other, "form").where((F.col("part") != F.col("other")) & ((few <= RARE) | (few * RARER <= many)))
    return met.where(near(F.col("text"), F.col("other_text"))).select("part", "other", (F.col("other_breadth") <= RARE).alias("rare"), F.col("other_top").alias("top")).distinct()


def _parents(ordered: DataFrame, keys: DataFrame) -> DataFrame:
    """``key, parent, rarity``: the better-established key to which a key is tied, if any, and the rarity of that rewriting.

    A key is better established if both its parts occur in other keys, then if more spellings share it.  The rarity of the
    rewriting to a key is that key's share of the spellings of all better keys that the rewriting admits and that aren't
    variants of that key themselves.
    """
    g = keys.groupBy("given").agg(F.count("*").alias("breadth_g"), F.max("n").alias("top_g"))
    s = keys.groupBy("surname").agg(F.count("*").alias("breadth_s"), F.max("n").alias("top_s"))
    written = ordered.where(F.length("given") > 1).select("given", "surname", F.split("written", r"\|").alias("w")).distinct()
    slips = {}
    for part, at, breadth in (("given", 0, g), ("surname", 1, s)):
        ways = written.select(F.col(part), F.get("w", F.lit(at)).alias("written")).distinct().join(breadth, part)
        slips[part] = cut(_slips(ways.toDF("part", "written", "breadth", "top")))
    common = F.least("breadth_g", "breadth_s")
    ranked = keys.join(g, "given").join(s, "surname").select(F.xxhash64("key").alias("id"), "key", "given", "surname", "middle", "n", F.struct((common > RARE).alias("known"), F.col("n").alias("n"), common.alias("common"), F.col("key").alias("key")).alias("rank"))
    ranked = cut(ranked)
    # a key with a rare part is better only than one that isn't known and has no more spellings; of the rest, most rewritten
    # keys are nobody's: two hashes travel until that is told
    may = ~F.col("rare") | (~F.col("rank.known") & (F.col("top") >= F.col("rank.n")))
    tried = None
    for part, to in (("given", ("other", "surname")), ("surname", ("given", "other"))):
        one = ranked.select("id", "given", "surname", "rank").join(slips[part], F.col(part) == F.col("part")).where(may).select("id", F.xxhash64(F.concat_ws("|", *to)).alias("to_id"))
        tried = one if tried is None else tried.unionByName(one)
    met = tried.join(ranked.select(F.col("id").alias("to_id")), "to_id", "left_semi")
    ours = ranked.select("id", "key", "given", "surname", "middle", "rank")
    there = ranked.select(F.col("id").alias("to_id"), F.col("given").alias("to_given"), F.col("surname").alias("to_surname"), F.col("middle").alias("theirs"), F.col("rank").alias("to_rank"), F.col("n").alias("to_n"))
    mine, theirs = F.col("middle"), F.col("theirs")
    agree = near(mine, theirs) | mine.startswith(theirs) | theirs.startswith(mine)
    one_part = (F.col("given") == F.col("to_given")) | (F.col("surname") == F.col("to_surname"))  # else two hashes are alike by chance
    edits = met.join(ours, "id").join(there, "to_id").where((F.col("to_rank") > F.col("rank")) & one_part & F.coalesce(agree, F.lit(True))).select("key", "to_rank", "to_n")
    words = ordered.where((F.length("given") > 1) & ~F.col("given").startswith("#")).select(F.concat_ws("|", "given", "surname").alias("key"), F.explode("words").alias("word")).distinct().join(ranked.select("key", "rank", "n"), "key")
    best = words.groupBy("word").agg(F.max(F.struct("rank", "n")).alias("to"))
    same = words.join(best, "word").where("to.rank > rank").select("key", F.col("to.rank").alias("to_rank"), F.col("to.n").alias("to_n"))
    pairs = cut(edits.unionByName(same).select("key", F.col("to_rank.key").alias("to"), "to_rank", F.col("to_n").alias("n")).distinct())
    best = pairs.groupBy("key").agg(F.max(F.struct("to_rank", "n")).alias("best")).select("key", F.col("best.to_rank.key").alias("parent"), F.col("best.n").alias("own"))
    # a better key that may itself be written for the best one is no rival of it
    rivals = pairs.join(best, "key").where("to <> parent").select("key", "to", "parent", "n")
    rivals = rivals.join(pairs.select(F.col("key").alias("to"), F.col("to").alias("parent")), ["to", "parent"], "left_anti").groupBy("key").agg(F.sum("n").alias("others"))
    ties = best.join(rivals, "key", "left").select("key", "parent", (F.col("own") / (F.col("own") + F.coalesce("others", F.lit(0)))).alias("rarity"))
    return ties.where(F.col("rarity") > DECIDES)


def _roots(keys: DataFrame, parents: DataFrame) -> DataFrame:
    """``key, root`` for every key, by pointer doubling."""
    at = cut(keys.select("key").join(parents.select("key", "parent"), "key", "left").select("key", F.coalesce("parent", "key").alias("root")))
    for _ in range(ROUNDS):
        up = at.select(F.col("key").alias("root"), F.col("root").alias("next"))
        further = cut(at.join(up, "root", "left").select("key", F.coalesce("next", "root").alias("root"), (F.coalesce("next", "root") != F.col("root")).alias("moved")))
        at = further.select("key", "root")
        if further.where("moved").isEmpty():
            return at
    raise RuntimeError("ties form longer chains than pointer doubling was allowed for")


def entities(read: DataFrame) -> DataFrame:
    """``name, entity, rule, rarity``: the entity of each spelling, by which rule, and 1 / keys that the rewriting admits."""
    read = cut(read)
    ordered = cut(_ordered(read))
    keys = cut(_keys(ordered))
    parents = cut(_parents(ordered, keys))
    roots = cut(keys.join(_roots(keys, parents), "key").join(parents.select("key", "rarity"), "key", "left"))
    whole = ordered.where(F.length("given") > 1).withColumn("key", F.concat_ws("|", "given", "surname")).join(roots.select("key", "root", "rarity"), "key")
    whole = whole.select("name", F.col("root").alias("entity"), F.when(F.col("key") == F.col("root"), "key").otherwise("slip").alias("rule"), F.coalesce("rarity", F.lit(1.0)).alias("rarity"))

    initials = ordered.where(F.length("given") == 1)
    people = roots.where(~F.col("given").startswith("#"))
    there = people.select(F.substring("given_w", 1, 1).alias("initial"), F.explode(one_letter_less("surname")).alias("form"), "surname", "root", F.col("middle").alias("known"))
    tried = initials.select("name", F.col("given").alias("initial"), F.explode(one_letter_less("surname")).alias("form"), F.col("surname").alias("read"), "middle")
    met = tried.join(there, ["initial", "form"]).where(near(F.col("read"), F.col("surname")))
    fits = F.when(F.col("middle") == "", F.lit(1)).when(F.col("known").isNull(), F.lit(0)).when(F.length("middle") == 1, F.when(F.col("known").startswith(F.col("middle")), 2)).when(near(F.col("middle"), F.col("known")), 3)
    candidates = met.withColumn("fits", fits).where("fits IS NOT NULL").groupBy("name", "root").agg(F.max(F.struct((F.col("read") == F.col("surname")).cast("int").alias("exact"), "fits")).alias("q"))
    best = candidates.groupBy("name").agg(F.max("q").alias("best"))
    top = candidates.join(best, "name").where("q = best").groupBy("name").agg(F.count("*").alias("n"), F.max("root").alias("entity"))
    linked = top.select("name", "entity", F.lit("initial").alias("rule"), (1.0 / F.col("n")).alias("rarity")).where(F.col("rarity") > DECIDES)

    # what is left is its own reading
    own = initials.select("name", F.concat_ws("|", F.lit("~"), "given", "middle", "surname").alias("reading"))
    rest = read.join(whole.select("name").unionByName(linked.select("name")), "name", "left_anti").join(own, "name", "left")
    alone = rest.select("name", F.coalesce("reading", F.get("words", F.lit(0))).alias("entity"), F.lit("alone").alias("rule"), F.lit(1.0).alias("rarity"))
    return whole.unionByName(linked).unionByName(alone)


def linked_pairs(named: DataFrame) -> DataFrame:
    """``name_a, name_b``: all pairs of different spellings of one entity, name_a first by code point."""
    a = named.select("entity", F.col("name").alias("name_a"))
    b = named.select("entity", F.col("name").alias("name_b"))
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")
