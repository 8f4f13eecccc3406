"""Matching entities across sources without keys: loopy belief propagation with one-to-one factors.

A variable is a candidate pair (record descriptor, customer) with a prior log odds from the attributes that agree.  Two
factors bind the variables: a descriptor concerns at most one customer, and of a customer a source knows at most one identity
(its descriptors of one *slot*, such as one person's spellings or addresses, belong together; those of other slots are
rivals).  Messages are exchanged through aggregations and equi-joins until the marginals settle:

* to a variable from its descriptor: minus log(1 + sum of the odds of the descriptor's other customers),
* to a variable from its customer: minus log(1 + r / (1 + w)), where r is the sum over the customer's other slots of the best
  odds there and w the odds of the other descriptors in the variable's own slot, which speak for the same identity.

The marginal is the logistic function of prior and both messages; a link is given where it exceeds one half.  Pairs without
any rival hold their marginal from the start and take no part in the rounds.  All sources are one graph, solved at once.

What the priors don't say, the factors do: twins with one birth date and initial, namesakes, holders of a shared phone and
addresses near two customers are rivals of a descriptor; an event with a customer's phone beside a stranger's address is
another identity than the customer's own, which stands in the graph as an anchor.

Equal records are one descriptor, so that copies cost nothing; the dates of a name that agree with no customer are one
descriptor too, so that pairs grow with the customers of a name, not with their product.  Candidates come from equi-joins only.

Defined cases: a descriptor without candidates is linked to none; two equally good customers leave both below one half,
so that there is no link; null attributes are no evidence; empty tables give no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decisionlake.llm import names
from decisionlake.llm.name_forms import PLACEHOLDERS
from decisionlake.llm.survivors import good_phone
from decisionlake.session import cut

#: Rounds without damping, and in all; messages that haven't settled by then are an error.
FREE_ROUNDS = 6
ROUNDS = 60
SETTLED = 1e-3
#: Log odds of a customer who shares a record's whole name, its initial and nearly its surname, its address, an address near
#: it, its phone, its Emirates ID.
NAME, INITIAL, ADDRESS, NEAR, PHONE, ID = 5.0, 1.0, 8.0, 4.0, 4.0, 8.0
#: The share of right birth dates on records: what agreement and disagreement weigh follows from it and a date's frequency.
RIGHT_DATE = 0.9
_OWN = "own"


def _logistic(c: Column) -> Column:
    return 1 / (1 + F.exp(-c))


def marginals(candidates: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``descriptor, customer, probability`` from ``descriptor, customer, slot, prior`` (log odds), one row per pair."""
    candidates = cut(candidates.select("descriptor", "customer", "slot", "prior"))
    alone = candidates.groupBy("descriptor").agg((F.count("*") == 1).alias("sole"))
    owned = candidates.groupBy("customer").agg((F.min("slot") == F.max("slot")).alias("one"))
    known = cut(candidates.join(alone, "descriptor").join(owned, "customer"))
    settled = known.where("sole AND one").select("descriptor", "customer", _logistic(F.col("prior")).alias("probability"))
    now = cut(known.where("NOT (sole AND one)").select("descriptor", "customer", "slot", "prior", F.lit(0.0).alias("down"), F.lit(0.0).alias("across"), F.col("prior").alias("belief")))
    if now.isEmpty():
        return settled
    for n in range(rounds):
        keep = 0.0 if n < FREE_ROUNDS else 0.5
        damped = lambda new, old, keep=keep: (1 - keep) * new + keep * old
        up = now.withColumn("o", F.exp(F.col("prior") + F.col("across")))
        sums = up.groupBy("descriptor").agg(F.sum("o").alias("all"))
        down = up.join(sums, "descriptor").withColumn("down", damped(-F.log1p(F.greatest(F.col("all") - F.col("o"), F.lit(0.0))), F.col("down"))).drop("all", "o")
        sent = down.withColumn("o", F.exp(F.col("prior") + F.col("down")))
        slots = sent.groupBy("customer", "slot").agg(F.max("o").alias("s"), F.sum("o").alias("within"))
        whole = slots.groupBy("customer").agg(F.sum("s").alias("all"))
        others = slots.join(whole, "customer").select("customer", "slot", "within", F.greatest(F.col("all") - F.col("s"), F.lit(0.0)).alias("rival"))
        new = -F.log1p(F.col("rival") / (1 + F.greatest(F.col("within") - F.col("o"), F.lit(0.0))))
        then = sent.join(others, ["customer", "slot"]).withColumn("across", damped(new, F.col("across"))).drop("o", "within", "rival")
        now = cut(then.withColumn("old", F.col("belief")).withColumn("belief", F.col("prior") + F.col("down") + F.col("across")))
        moved = now.agg(F.max(F.abs(_logistic(F.col("belief")) - _logistic(F.col("old"))))).first()[0]
        now = now.drop("old")
        if n > 0 and moved < SETTLED:
            return settled.unionByName(now.select("descriptor", "customer", _logistic(F.col("belief")).alias("probability")))
    raise RuntimeError(f"beliefs haven't settled in {rounds} rounds")


def birth_date(text: Column) -> Column:
    """A birth date of any notation (ISO, day/month/year, day month-name year, eight digits) as ``yyyy-MM-dd``; else null."""
    t = F.trim(text)
    formats = ((r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"), (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"), (r"^\d{8}$", "yyyyMMdd"), (r"^\d{2} [A-Za-z]{3} \d{4}$", "dd MMM yyyy"))
    return F.coalesce(*[F.when(t.rlike(p), F.date_format(F.try_to_timestamp(t, F.lit(f)), "yyyy-MM-dd")) for p, f in formats])


def email_key(email: Column) -> Column:
    """Lower case without white space, tag after a plus and doubled dots; null for blanks and placeholders.

    A typed address may have lost its @, so that a letter and a dot are all that is asked for.
    """
    e = F.regexp_replace(F.lower(email), r"\s", "")
    e = F.regexp_replace(F.regexp_replace(e, r"\+[^@]*@", "@"), r"\.{2,}", ".")
    return F.when(e.contains("@") | (e.contains(".") & e.rlike(r"\p{L}") & ~e.isin(*sorted(PLACEHOLDERS))), e)


def record_key(identifier: Column) -> Column:
    return F.nullif(F.upper(F.trim(identifier)), F.lit(""))


def _slotted(pairs: DataFrame) -> DataFrame:
    """With ``slot``: the entities of a customer that are one person's have one slot, so that they aren't rivals.

    They are if they are the customer's ``own`` (a birth date agrees, or the feed writes one beside the name), or if given
    name and surname begin alike with such a one, or with one another, in either order.
    """
    part = lambda i: F.get(F.split("entity", r"\|"), F.lit(i))
    outer = F.when(F.col("entity").startswith("~|"), F.array(part(1), part(3))).when(F.col("entity").contains("|"), F.array(part(0), part(1)))
    kin = F.coalesce(F.array_join(F.array_sort(F.transform(outer, lambda w: F.substring(w, 1, 1))), "|"), F.col("entity"))
    pairs = pairs.withColumn("kin", kin)
    own = pairs.groupBy("customer", "kin").agg(F.max("own").alias("any"))
    return pairs.join(own, ["customer", "kin"]).withColumn("slot", F.when(F.col("any"), F.lit("own")).otherwise(F.col("kin"))).drop("kin", "any")


def links(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """``internal_customer_uuid, record_key, confidence`` from ``record_key, descriptor`` and the candidate pairs."""
    won = marginals(candidates).where("probability > 0.5")
    return records.distinct().join(won, "descriptor").groupBy(F.substring_index("customer", "~", -1).alias("internal_customer_uuid"), "record_key").agg(F.max("probability").alias("confidence"))


def _graph(source: str, records: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with descriptors and customers of their own in the one graph."""
    named = lambda c: F.concat(F.lit(f"{source}~"), F.col(c)).alias(c)
    return records.select("record_key", named("descriptor")), candidates.select(named("descriptor"), named("customer"), "slot", "prior")


def screening_evidence(screenings: DataFrame, feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and candidate pairs of screenings by name and birth date."""
    known = feed.where("internal_customer_uuid IS NOT NULL").select(F.col("internal_customer_uuid").alias("customer"), "full_name", birth_date(F.col("date_of_birth")).alias("born")).distinct()
    asked = screenings.select(record_key(F.col("screening_ref")).alias("record_key"), "full_name", birth_date(F.col("date_of_birth")).alias("born")).where("record_key IS NOT NULL")
    named = cut(names.entities(names.spellings(screenings.select("full_name"), feed.select("full_name"))).select(F.col("name").alias("full_name"), "entity", "rule"))
    known = cut(known.join(named, "full_name", "left").select("customer", "entity", "born", "rule").distinct())
    people = cut(known.where("entity IS NOT NULL").groupBy("customer", "entity").agg(F.max(F.col("born").isNotNull()).alias("dated")))
    births = known.where("born IS NOT NULL").select("customer", "born").distinct()
    # agreement weighs as much as the date is rare among the customers
    dates = births.groupBy("born").agg(F.count("*").alias("n"))
    total = births.agg(F.count("*").alias("total"))  # one row
    weights = dates.crossJoin(F.broadcast(total)).select("born", F.greatest(F.log(RIGHT_DATE * F.col("total") / F.col("n")), F.lit(0.0)).alias("weight"))
    births = cut(births.join(weights, "born"))

    read = cut(asked.join(named, "full_name").select("record_key", "entity", "born").distinct())
    wanted = cut(read.select("entity", "born").distinct())
    agreeing = wanted.join(people.join(births, "customer"), ["entity", "born"]).select("entity", "born", "customer", "dated", "weight")
    # an initial and nearly the surname of a customer with that birth date, whether names alone place the spelling or not
    outer = lambda e, at: F.get(F.split(e, r"\|"), F.lit(at))
    surname = lambda e: F.when(e.startswith("~|"), outer(e, 3)).otherwise(outer(e, 1))
    initial = lambda e: F.substring(F.when(e.startswith("~|"), outer(e, 1)).otherwise(outer(e, 0)), 1, 1)
    # a slip leaves the first or the last letter of a surname as it was: each is a block
    blocks = lambda sn: F.explode(F.array(F.concat(F.lit("<"), F.substring(sn, 1, 1)), F.concat(F.lit(">"), F.substring(sn, -1, 1))))
    person = F.col("entity").contains("|") & ~F.col("entity").startswith("#")
    ours = wanted.where(person & F.col("born").isNotNull()).select("entity", "born", initial(F.col("entity")).alias("initial"), surname(F.col("entity")).alias("surname")).withColumn("block", blocks(F.col("surname")))
    theirs = people.where(person).join(births, "customer").select("customer", "born", "weight", initial(F.col("entity")).alias("initial"), surname(F.col("entity")).alias("their")).distinct().withColumn("block", blocks(F.col("their")))
    alike = ours.join(theirs, ["born", "initial", "block"]).where(names.near(F.col("surname"), F.col("their"))).select("entity", "born", "customer", F.lit(True).alias("dated"), "weight").distinct()
    by_date = cut(agreeing.select("*", F.lit(NAME).alias("odds")).unionByName(alike.select("*", F.lit(INITIAL).alias("odds"))))
    dated = by_date.select(F.concat_ws("~", "entity", "born").alias("descriptor"), "entity", "customer", F.lit(True).alias(_OWN), (F.col("odds") + F.col("weight")).alias("prior"))

    met = by_date.select("entity", "born").distinct().withColumn("met", F.lit(True))
    described = F.concat_ws("~", "entity", F.when(F.col("met"), F.col("born")).when(F.col("born").isNull(), F.lit("?")).otherwise(F.lit("!")))
    every = cut(wanted.join(met, ["entity", "born"], "left").select("entity", "born", "met", described.alias("descriptor")))
    rest = every.where("met IS NULL").select("descriptor", "entity", F.col("born").isNull().alias("undated")).distinct()
    by_name = rest.join(people, "entity").select("descriptor", "entity", "customer", F.col("dated").alias(_OWN), (F.lit(NAME) + F.when(F.col("undated"), 0.0).otherwise(F.log(F.lit(1 - RIGHT_DATE)))).alias("prior"))
    pairs = cut(dated.unionByName(by_name).groupBy("descriptor", "entity", "customer").agg(F.max(_OWN).alias(_OWN), F.max("prior").alias("prior")))
    records = cut(_described(read, every))
    return records, _slotted(pairs).select("descriptor", "customer", "slot", "prior")


def _described(read: DataFrame, every: DataFrame) -> DataFrame:
    """``record_key, descriptor``; an unknown birth date is a value like others here."""
    key = F.concat_ws("~", "entity", F.coalesce("born", F.lit("?")))
    return read.select("record_key", key.alias("k")).join(every.select(key.alias("k"), "descriptor"), "k").select("record_key", "descriptor")


def _near_addresses(strange: DataFrame, addresses: DataFrame) -> DataFrame:
    """``email, theirs``: addresses within one edit, met on hashes of what is left when a letter goes."""
    forms = lambda df, c: df.select(c, F.explode(names.one_letter_less(c)).alias("f")).select(c, F.xxhash64("f").alias("form"))
    met = forms(strange, "email").join(forms(addresses.withColumnRenamed("email", "theirs"), "theirs"), "form")
    return met.where(names.near(F.col("email"), F.col("theirs"))).select("email", "theirs").distinct()


def fraud_evidence(events: DataFrame, feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and candidate pairs of fraud events by e-mail and phone."""
    people = feed.where("internal_customer_uuid IS NOT NULL").select(F.col("internal_customer_uuid").alias("customer"), email_key(F.col("email")).alias("email"), good_phone(F.col("phone")).alias("phone"))
    emails = cut(people.where("email IS NOT NULL").select("customer", "email").distinct())
    phones = cut(people.where("phone IS NOT NULL").select("customer", "phone").distinct())
    asked = events.select(record_key(F.col("event_id")).alias("record_key"), email_key(F.col("email")).alias("email"), good_phone(F.col("phone")).alias("phone")).where("record_key IS NOT NULL")
    records = cut(asked.where("email IS NOT NULL OR phone IS NOT NULL").withColumn("descriptor", F.concat_ws("~", F.coalesce("email", F.lit("?")), F.coalesce("phone", F.lit("?")))))
    wanted = cut(records.select("descriptor", "email", "phone").distinct())

    addresses = emails.select("email").distinct()
    strange = wanted.where("email IS NOT NULL").select("email").distinct().join(addresses, "email", "left_anti")
    typed = cut(_near_addresses(cut(strange), addresses)).join(emails.withColumnRenamed("email", "theirs"), "theirs").select("email", "customer").distinct()
    by_address = emails.select("email", "customer", F.lit(ADDRESS).alias("odds")).unionByName(typed.select("email", "customer", F.lit(NEAR).alias("odds")))
    has = phones.select("customer", "phone", F.lit(1.0).alias("same"))
    by_email = cut(wanted.join(by_address, "email").join(has, ["customer", "phone"], "left").select("descriptor", "customer", F.lit(_OWN).alias("slot"), (F.col("odds") + F.coalesce("same", F.lit(0.0))).alias("prior")))
    called = wanted.where("email IS NULL").join(phones, "phone").select("descriptor", "customer", F.lit(_OWN).alias("slot"), F.lit(PHONE).alias("prior"))
    # beside an address the phone of one customer alone is evidence; that address is then another identity than the customer's own
    sole = phones.groupBy("phone").agg(F.count("*").alias("n"), F.max("customer").alias("customer")).where("n = 1")
    beside = wanted.where("email IS NOT NULL AND phone IS NOT NULL").join(sole, "phone").select("descriptor", "customer", F.concat(F.lit("@"), "email").alias("slot"), F.lit(PHONE).alias("prior"))
    beside = cut(beside.join(by_email.select("descriptor", "customer"), ["descriptor", "customer"], "left_anti"))
    anchors = beside.select("customer").distinct().select(F.concat(F.lit("!"), "customer").alias("descriptor"), "customer", F.lit(_OWN).alias("slot"), F.lit(ADDRESS).alias("prior"))
    return records.select("record_key", "descriptor"), by_email.unionByName(called).unionByName(beside).unionByName(anchors)


def bureau_evidence(reports: DataFrame, feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records and candidate pairs of bureau reports by Emirates ID."""
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    holders = feed.where("internal_customer_uuid IS NOT NULL").select(F.col("internal_customer_uuid").alias("customer"), digits("emirates_id").alias("descriptor")).where("length(descriptor) = 15").distinct()
    asked = reports.select(F.col("aecb_report_ref").alias("record_key"), digits("emirates_id").alias("descriptor")).where("record_key IS NOT NULL AND length(descriptor) = 15").distinct()
    pairs = asked.select("descriptor").distinct().join(holders, "descriptor")
    return asked, pairs.select("descriptor", "customer", F.col("descriptor").alias("slot"), F.lit(ID).alias("prior"))


def customer_links(screenings: DataFrame, events: DataFrame, reports: DataFrame, feed: DataFrame) -> DataFrame:
    """The links of all three sources from one graph."""
    parts = [_graph("s", *screening_evidence(screenings, feed)), _graph("f", *fraud_evidence(events, feed)), _graph("b", *bureau_evidence(reports, feed))]
    records, candidates = parts[0]
    for r, c in parts[1:]:
        records, candidates = records.unionByName(r), candidates.unionByName(c)
    return links(records, candidates)


def screening_links(screenings: DataFrame, feed: DataFrame) -> DataFrame:
    return links(*screening_evidence(screenings, feed))


def fraud_links(events: DataFrame, feed: DataFrame) -> DataFrame:
    return links(*fraud_evidence(events, feed))
