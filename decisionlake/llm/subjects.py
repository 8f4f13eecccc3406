"""Subject areas of documents: labelling functions on sentences, put together by a latent model that learns their accuracy.

Five functions vote for one subject of a sentence or abstain, each on its own:

* lexicon: the terms (words and word pairs) whose weights by subject were learned from labelled documents,
* title: words of the subjects' own titles and descriptions,
* section: what most other sentences of the same section are about (headings and blank lines part sections),
* address: subject words in hosts and mailboxes of addresses,
* source: the subject that is over-represented in the document's source.

The latent model has a class per subject and one for sentences about none.  Of every function it learns how often it speaks
on a sentence about a subject, how often on one about none, and how often it is then right, by expectation maximisation over
the patterns of votes of all documents that didn't teach the lexicon, beginning from the lexicon's score on labels that it
hadn't seen.  A sentence's votes, abstentions included, thus give
posterior probabilities of all classes, and a document has a subject if it is more likely than not that at least ``SHARE`` of
its sentences about any subject are about it (exactly, by adding up the sentences' probabilities as independent).

The texts are read once: what is kept of a sentence is its pattern of votes, a small number.  The lexicon is fitted on at most
``SAMPLE`` labelled documents; terms are hashed to ``BUCKETS`` places, so that no term is left out and every worker's weights
have one size.  Leanings of sources and counts of patterns are aggregates over all documents.

Courtesies and references vote for nothing, and quoted evaluation items are left out: passages between ellipses that hold a
stretch of an item, and sentences at least half of which lie in a span where the item automaton follows one item.

Defined cases: null, empty and blank texts have no subject; unknown subjects in the labels are ignored; without any label the
lexicon is silent and the other functions decide; without any subject there is no row; rows without a document id are documents too, their id is null.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decisionlake.llm.contamination import ItemAutomaton, normalised
from decisionlake.session import cut

#: The lexicon is fitted on at most so many labelled documents.
SAMPLE = 6_000
#: Terms are hashed to so many places.
BUCKETS = 1 << 18
SHARE = 1 / 6
#: A lexicon votes if its subject is that sure.
SURE = 0.8
ROUNDS = 12
#: A quotation holds so many different words' places of an item, with so many other words in a row at most.
QUOTED = 14
GAP = 10
#: The functions that look at a sentence's own words are held to speak of subjects only with the weight of this share of all
#: sentences; without that, sentences about none could as well be ones that the functions overlook.
FIRM = 0.25
OWN_WORDS = (0, 1)
FUNCTIONS = ("lexicon", "title", "section", "address", "source")
#: Words known to a worker's memo at most.
MEMO = 500_000
# Words of titles that say nothing of a subject.
STOP = frozenset("a an and as at by for from in of on or the to with".split())

_LINE = re.compile(r"(?m)^[ \t]*(?:>+[ \t]?)+")
_HEAD = re.compile(r"(?m)^[ \t]*#+[ \t]*(?:\d+(?=\s))?")
_LEAD = re.compile(r"(?m)^[ \t]*(?:\[\d{1,2}:\d{2}\][ \t]*[^\s:]+[ \t]*:|[-*•]|\d{1,3}[.)]|#+[ \t]*\d*)[ \t]+")
_BREAK = re.compile(r"<(?:br|/p|/div|p|div|td|/td)\s*/?>", re.I)
_END = re.compile(r"(?<=[.?!؟。])[\s ]+")
_BLANK = re.compile(r"\n(?=[ \t]*\n)")
_ADDRESS = re.compile(r"(?:https?://|www\.)[^\s<>]+|[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_PART = "\ue000"  # a private mark before the first sentence of a section


def unquoted(text: str, items: ItemAutomaton) -> str:
    """The text without the passages between two ellipses that hold a stretch of an item; other ellipses stay."""
    at, out = text.find("…"), []
    if at < 0:
        return text
    begin = 0
    while at >= 0:
        end = text.find("…", at + 1)
        if end < 0:
            break
        if items.stretches(normalised(text[at + 1 : end])):
            out += [text[begin:at], " "]
            begin = end + 1
            at = text.find("…", begin)
        else:
            at = end
    return "".join([*out, text[begin:]])


def sentences(text: str | None, items: ItemAutomaton | None = None) -> list[str]:
    """The sentences of a text, without reply marks, list marks, speakers and quoted items.

    A sentence that begins a section has a private mark before it.
    """
    if not text or text.isspace():
        return []
    text = text.replace("â€¦", "…").replace("\r\n", "\n").replace("\r", "\n").replace("&nbsp;", " ").replace(_PART, " ")
    if "<" in text:
        text = _BREAK.sub("\n", text)
    text = _LINE.sub("", text)
    if "#" in text:
        text = _HEAD.sub(_PART + " ", text)
    text = _LEAD.sub("", text)
    if items is not None:
        text = unquoted(text, items)
    text = _BLANK.sub("\n" + _PART, text)
    text = re.sub(r"(?<=[.?!؟])\s*\n+", " \n", text).replace("\n", " ")
    return [s for s in _END.split(text) if s.strip()]


class SubjectModel:
    """Lexicon weights and the titles' words: what the functions that look at a text alone need."""

    def __init__(self, areas: list[tuple[str, str]], passages: list[str]) -> None:
        self.subjects = sorted(s for s, _ in areas)
        self.at = {s: i for i, s in enumerate(self.subjects)}
        counts = {s: Counter(w for w in normalised(d.replace("_", " ")) if w not in STOP) for s, d in areas}
        everywhere = Counter(w for c in counts.values() for w in c)
        self.titles = {w: self.at[s] for s, c in counts.items() for w in c if everywhere[w] == 1}
        self.items = ItemAutomaton([(i, w) for i, p in enumerate(passages) if (w := normalised(p))])
        self.weights = np.zeros((BUCKETS, len(self.subjects) + 1), np.float32)
        self.prior = np.zeros(len(self.subjects) + 1)
        self.taught: frozenset[str] = frozenset()
        self.tested: float | None = None
        self.memo: dict[str, int] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"memo": {}}

    # ---- sentences ------------------------------------------------------------------------------------------------
    def read(self, text: str | None) -> list[tuple[str, list[str], int]]:
        """The sentences that may count, with their words and section: those that lie in a quoted item are left out."""
        found, section = [], 0
        for s in sentences(text, self.items):
            if _PART in s:
                section += 1
                s = s.replace(_PART, " ")
            if words := normalised(s):
                found.append((s, words, section))
        flat = [w for _, words, _ in found for w in words]
        if not any(len(p) >= QUOTED for p in self.items.places(flat).values()):
            return found
        quoted = self._quoted(flat)
        if not quoted:
            return found
        out, at = [], 0
        for s, words, section in found:
            inside = sum(quoted[at : at + len(words)])
            at += len(words)
            if 2 * inside < len(words):
                out.append((s, words, section))
        return out

    def _quoted(self, words: list[str]) -> list[bool]:
        """Which words lie in a quotation: a span without longer gaps that holds QUOTED different places of one item.

        A phrase that text and item share by chance holds few places, however often it comes.
        """
        nexts, link, length, window, stretch = self.items.next, self.items.link, self.items.length, self.items.window, self.items.stretch
        spans: dict[int, list] = {}  # by item: start, end and places of its open span
        closed: list[tuple[int, int]] = []
        state = n = 0
        for i, word in enumerate(words):
            while word not in nexts[state] and state > 0:
                state = link[state]
                n = length[state]
            if word not in nexts[state]:
                n = 0
                continue
            state, n = nexts[state][word], n + 1
            if n < stretch:
                continue
            for item, end in self.items.ends[window[state]]:
                span = spans.get(item)
                if span is None or i - stretch + 1 - span[1] > GAP:
                    if span is not None and len(span[2]) >= QUOTED:
                        closed.append((span[0], span[1]))
                    span = spans[item] = [i - stretch + 1, i, set()]
                span[1] = i
                span[2].update(range(end - stretch + 1, end + 1))
        closed += [(a, b) for a, b, places in spans.values() if len(places) >= QUOTED]
        if not closed:
            return []
        inside = [False] * len(words)
        for a, b in closed:
            inside[a : b + 1] = [True] * (b + 1 - a)
        return inside

    # ---- coding ---------------------------------------------------------------------------------------------------
    def _code(self, word: str) -> int:
        """The word's number, 0 for one of digits alone, times 2^16, and 1 + the subject whose title has it."""
        if len(self.memo) >= MEMO:
            self.memo.clear()
        number = 0 if word.isdigit() else zlib.crc32(word.encode("utf-8", "surrogatepass")) | 1
        code = self.memo[word] = number << 16 | self.titles.get(word, -1) + 1
        return code

    def coded(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """All sentences of some texts: each one's document, section, title and address vote, and its terms.

        ``terms`` are places of words and pairs of neighbours, ``of`` the sentence of each.
        """
        memo, code, k = self.memo, self._code, len(self.subjects)
        docs, parts, addresses, lengths, words = [], [], [], [], []
        for n, text in enumerate(texts):
            if not isinstance(text, str):
                continue
            for s, own, section in self.read(text):
                docs.append(n)
                parts.append(section)
                lengths.append(len(own))
                words += [memo.get(w) or code(w) for w in own]
                addresses.append(self._address(s) if "@" in s or "://" in s or "www." in s else 0)
        m = len(docs)
        codes = np.array(words, np.int64)
        numbers = codes >> 16
        of = np.repeat(np.arange(m), lengths)
        hits = np.bincount(of * (k + 1) + (codes & 0xFFFF), minlength=m * (k + 1)).reshape(m, k + 1)[:, 1:]
        kept = numbers > 0
        number, own = numbers[kept].astype(np.uint64), of[kept]
        next_to = own[1:] == own[:-1]
        both = number[:-1] * np.uint64(0x9E3779B1) + number[1:] * np.uint64(0x85EBCA77)
        spread = lambda x: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64) % BUCKETS
        return {
            "doc": np.array(docs, np.int64), "section": np.array(parts, np.int64), "title": _leading(hits), "address": np.array(addresses, np.int64),
            "terms": np.concatenate([spread(number), spread(both[next_to])]), "of": np.concatenate([own, own[1:][next_to]]), "hits": hits,
        }

    def _address(self, sentence: str) -> int:
        hosts = Counter(self.titles[w] for a in _ADDRESS.findall(sentence) for w in normalised(a) if w in self.titles).most_common(1)
        return hosts[0][0] + 1 if hosts else 0

    # ---- the lexicon ----------------------------------------------------------------------------------------------
    def learn(self, c: dict[str, np.ndarray], given: list[list[int]]) -> None:
        """Naive Bayes by expectation maximisation: a labelled document's sentences are about one of its subjects, or about none."""
        k, m = len(self.subjects), len(c["doc"])
        if not m:
            return
        may = np.full((len(given), k + 1), 0.03)
        may[:, k] = 0.4
        for n, subjects in enumerate(given):
            may[n, subjects] = 1.0
        allow = may[c["doc"]]
        allow[:, :k] += allow[:, :k] * 2.0 * c["hits"]
        places, term, seen = np.unique(c["terms"], return_inverse=True, return_counts=True)
        of, base = c["of"], np.log(allow)
        posterior = allow / allow.sum(1, keepdims=True)
        for _ in range(ROUNDS):
            use = np.stack([np.bincount(term, posterior[of, j], len(places)) for j in range(k + 1)], 1)
            phi = use + 0.02
            weights = np.log(phi / phi.sum(0))
            prior = np.log((posterior.sum(0) + 1) / (m + k + 1))
            score = np.stack([np.bincount(of, weights[term, j], m) for j in range(k + 1)], 1) + prior + base
            score = np.exp(score - score.max(1, keepdims=True))
            posterior = score / score.sum(1, keepdims=True)
        again = seen >= 2  # a term met once tells nothing
        self.weights[places[again]] = weights[again]
        self.prior = prior

    def teach(self, texts: list[str], given: list[list[int]]) -> None:
        """Learn from all, after a test: each half's votes by what the other half taught, against the half's own labels."""
        coded = self.coded(texts)
        right = said = 0
        for half in (0, 1):
            self.weights[:] = 0
            self.learn(_of_documents(coded, coded["doc"] % 2 != half), given)
            c = _of_documents(coded, coded["doc"] % 2 == half)
            votes = self.lexicon(c)
            for n, v in zip(c["doc"][votes > 0], votes[votes > 0]):
                said += 1
                right += int(v) - 1 in given[n]
        self.tested = (right + 1) / (said + 2) if said else None
        self.weights[:] = 0
        self.learn(coded, given)

    def lexicon(self, c: dict[str, np.ndarray]) -> np.ndarray:
        """1 + the subject of which a sentence's terms make sure, else 0."""
        m, k = len(c["doc"]), len(self.subjects)
        gathered = self.weights[c["terms"]]
        known = np.bincount(c["of"], gathered[:, 0] != 0, m) > 0
        score = np.stack([np.bincount(c["of"], gathered[:, j], m) for j in range(k + 1)], 1) + self.prior
        best = score.argmax(1)
        sure = 1 / np.exp(score - score.max(1, keepdims=True)).sum(1) >= SURE
        return np.where(known & sure & (best < k), best + 1, 0)

    # ---- voting ---------------------------------------------------------------------------------------------------
    def patterns(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every sentence its document, its lexicon vote and its votes packed into one number, the source's left open."""
        c, k = self.coded(texts), len(self.subjects)
        lexicon = self.lexicon(c)
        block = np.cumsum(np.r_[0, (np.diff(c["doc"]) != 0) | (np.diff(c["section"]) != 0)]) if len(lexicon) else lexicon
        says = np.where(lexicon > 0, lexicon, c["title"])
        around = np.zeros((int(block[-1]) + 1 if len(block) else 0, k), np.int64)
        spoke = np.nonzero(says)[0]
        np.add.at(around, (block[spoke], says[spoke] - 1), 1)
        others = around[block]
        others[spoke, says[spoke] - 1] -= 1
        section = _leading(others)
        b = k + 1
        return c["doc"], lexicon, lexicon + b * (c["title"] + b * (section + b * c["address"]))


def _of_documents(c: dict[str, np.ndarray], kept: np.ndarray) -> dict[str, np.ndarray]:
    """Some of the coded sentences."""
    of = np.cumsum(kept) - 1
    terms = kept[c["of"]]
    return {k: v[terms] if k in ("terms", "of") else v[kept] for k, v in c.items()} | {"of": of[c["of"][terms]]}


def _leading(counts: np.ndarray) -> np.ndarray:
    """1 + the column that leads in each row; 0 without a single leader."""
    if not len(counts):
        return np.zeros(0, np.int64)
    top = counts.max(1)
    return np.where((top > 0) & ((counts == top[:, None]).sum(1) == 1), counts.argmax(1) + 1, 0)


class LatentModel:
    """What votes are worth: of every function, how it votes or abstains on sentences about each subject and about none.

    ``table[function, class, vote]`` are probabilities; class K is none, vote 0 is silence.  A function that votes alike
    whatever the class thus comes to count for nothing.
    """

    def __init__(self, subjects: int, tested: float | None = None) -> None:
        """tested: the share of right lexicon votes on labelled documents by which the lexicon wasn't taught, if known."""
        self.k = k = subjects
        # where learning begins: lexicon, title and address speak of subjects only, the others whatever the sentence
        accuracy = (0.95 if tested is None else min(max(tested, 1 / k), 0.999), 0.7, 0.6, 0.7, 0.3)
        self.table = np.zeros((len(FUNCTIONS), k + 1, k + 1))
        for j, (right, speaks, idle) in enumerate(zip(accuracy, (0.95, 0.5, 0.8, 0.5, 0.9), (0.02, 0.05, 0.8, 0.05, 0.9))):
            self.table[j, :k, 1:] = speaks * (right * np.eye(k) + (1 - right) / max(1, k - 1) * (1 - np.eye(k)))
            self.table[j, :k, 0] = 1 - speaks
            self.table[j, k] = [1 - idle, *[idle / k] * k]
        self.prior = np.full(k + 1, 1 / (k + 1))

    @property
    def accuracy(self) -> np.ndarray:
        """Of every function the share of right votes among those on sentences about a subject."""
        about = self.prior[: self.k]
        right = (about * np.diagonal(self.table[:, : self.k, 1:], axis1=1, axis2=2)).sum(1)
        return right / (about * (1 - self.table[:, : self.k, 0])).sum(1)

    def unpacked(self, patterns: np.ndarray) -> np.ndarray:
        b = self.k + 1
        return np.stack([patterns // b**j % b for j in range(len(FUNCTIONS))], 1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Of each row of votes (0 abstains, else 1 + subject) the probability of every subject and of none."""
        score = np.log(self.prior) + sum(np.log(self.table[j][:, votes[:, j]]).T for j in range(len(FUNCTIONS)))
        score = np.exp(score - score.max(1, keepdims=True))
        return score / score.sum(1, keepdims=True)

    def learn(self, votes: np.ndarray, times: np.ndarray, rounds: int = 50) -> None:
        """Expectation maximisation over the patterns that occur and how often each does."""
        first, total = self.table.copy(), times.sum()
        for _ in range(rounds if len(votes) else 0):
            p = self.posterior(votes) * times[:, None]
            for j in range(len(FUNCTIONS)):
                met = np.stack([np.bincount(votes[:, j], p[:, c], self.k + 1) for c in range(self.k + 1)])
                weight = (FIRM * total if j in OWN_WORDS else 1.0) / (self.k + 1)
                self.table[j] = np.maximum((met + weight * first[j]) / (met.sum(1, keepdims=True) + weight), 1e-6)
            self.prior = (p.sum(0) + 1) / (total + self.k + 1)


def reaches(posterior: np.ndarray, s: int, share: float = SHARE) -> float:
    """The probability that at least ``share`` of a document's sentences about any subject are about subject s, and some are.

    A sentence about s adds 1 / share - 1, one about another takes 1; the sum must not be negative.  The sentences'
    distributions are folded in one after another.
    """
    k, unit, n = posterior.shape[1] - 1, round(1 / share), len(posterior)
    mass = np.zeros((2, (unit + 1) * n + 1))  # whether s was met at all; the sum, beginning at -n
    mass[0, n] = 1.0
    for p in posterior:
        yes, none = p[s], p[k]
        moved = mass * none
        moved[:, :-1] += mass[:, 1:] * (1 - yes - none)
        moved[1, unit - 1 :] += (mass[0] + mass[1])[: mass.shape[1] - unit + 1] * yes
        mass = moved
    return float(mass[1, n:].sum())


def assigned(posterior: np.ndarray, starts: np.ndarray, share: float = SHARE) -> tuple[np.ndarray, np.ndarray]:
    """Of documents, each with the sentences from its start on: expected shares, and which subjects are likelier than not.

    Where the mean of the sum of ``reaches`` lies further from the limit than its deviation, Cantelli's inequality settles
    whether the probability exceeds one half; only the others are folded.
    """
    k, unit = posterior.shape[1] - 1, round(1 / share)
    about = posterior[:, :k]
    other = about.sum(1, keepdims=True) - about
    mean = (unit - 1) * about - other
    spread = (unit - 1) ** 2 * about + other - mean**2
    total = np.add.reduceat(about, starts)
    mean, deviation = np.add.reduceat(mean, starts), np.sqrt(np.maximum(np.add.reduceat(spread, starts), 0))
    out = mean - 0.5 > deviation
    ends = np.r_[starts[1:], len(posterior)]
    for d, s in zip(*np.nonzero(~out & (mean >= -deviation) & (total > 1e-9))):
        out[d, s] = reaches(posterior[starts[d] : ends[d]], s, share) > 0.5
    return total / np.maximum(total.sum(1, keepdims=True), 1e-12), out


def fitted(texts: DataFrame, labels: DataFrame, areas: DataFrame, items: DataFrame) -> SubjectModel:
    """The lexicon, taught by at most SAMPLE labelled documents, chosen by a hash of their ids."""
    listed = [(r[0], f"{r[0]} {r[1] or ''} {r[2] or ''}") for r in areas.select("subject", "title", "description").collect() if r[0]]  # the fixed list of subjects
    passages = [r[0] for r in items.select("passage").collect() if r[0]]  # the fixed test set
    model = SubjectModel(listed, passages)
    if not model.subjects:
        return model
    known = labels.where(F.col("doc_id").isNotNull() & F.col("subject").isin(model.subjects)).select("doc_id", "subject").distinct()
    chosen = known.groupBy("doc_id").agg(F.collect_set("subject").alias("given")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    taught = texts.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").toPandas()
    model.teach(taught["text"].tolist(), [[model.at[g] for g in given] for given in taught["given"]])
    model.taught = frozenset(taught["doc_id"].astype(str))
    return model


def sentence_votes(texts: DataFrame, model: SubjectModel) -> DataFrame:
    """``doc_id, source, taught, lexicon, patterns``: of each document the packed votes of its sentences."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            doc, lexicon, patterns = model.patterns(batch["text"].tolist())
            ends = np.searchsorted(doc, np.arange(len(batch) + 1))
            has = np.nonzero(np.diff(ends))[0]
            ids = batch["doc_id"].to_numpy()[has]
            yield pd.DataFrame({
                "doc_id": ids, "source": batch["source"].to_numpy()[has], "taught": [i in model.taught for i in ids],
                "lexicon": [lexicon[ends[n] : ends[n + 1]].astype(np.int8) for n in has], "patterns": [patterns[ends[n] : ends[n + 1]].astype(np.int32) for n in has],
            })

    # ids travel as text: whole numbers beside nulls would come as floating point
    asked = texts.where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "source")
    return asked.mapInPandas(scan, "doc_id string, source string, taught boolean, lexicon array<tinyint>, patterns array<int>")


def leanings(votes: DataFrame) -> DataFrame:
    """``source, lean``: 1 + the subject whose share of a source's lexicon votes most exceeds its share of all."""
    counts = votes.where("source IS NOT NULL").select("source", F.explode("lexicon").alias("v")).where("v > 0").groupBy("source", "v").agg(F.count("*").alias("n"))
    everywhere = counts.groupBy("v").agg(F.sum("n").alias("of"))  # one row per subject
    lift = counts.join(F.broadcast(everywhere), "v").withColumn("lift", F.col("n") / F.col("of"))
    return lift.groupBy("source").agg(F.max_by("v", F.struct("lift", "n", "v")).cast("int").alias("lean"))


def subject_shares(texts: DataFrame, labels: DataFrame, areas: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, subject, share``: the subjects that a document more likely than not has.

    share: the expected share of its sentences about any.
    """
    spark, kind = texts.sparkSession, texts.schema["doc_id"].dataType.simpleString()
    model = fitted(texts, labels, areas, items)
    k, subjects = len(model.subjects), model.subjects
    if not subjects:
        return texts.select("doc_id", F.lit("").alias("subject"), F.lit(0.0).alias("share")).where("false")
    votes = cut(sentence_votes(texts, model))
    open_ = (k + 1) ** (len(FUNCTIONS) - 1)
    full = votes.join(leanings(votes), "source", "left").select("doc_id", "taught", "patterns", F.coalesce("lean", F.lit(0)).alias("lean"))
    counts = full.select("taught", "lean", F.explode("patterns").alias("p")).groupBy("taught", "lean", "p").agg(F.count("*").alias("n")).toPandas()  # at most (k + 1)^5 patterns twice
    fresh = counts[~counts["taught"]] if (~counts["taught"]).any() else counts
    latent = LatentModel(k, model.tested)
    latent.learn(latent.unpacked(fresh["p"].to_numpy(np.int64) + open_ * fresh["lean"].to_numpy(np.int64)), fresh["n"].to_numpy(float))
    shared = spark.sparkContext.broadcast(latent)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        latent = shared.value
        for batch in batches:
            lengths = batch["patterns"].map(len).to_numpy()
            flat = np.concatenate([*batch["patterns"], np.zeros(0, np.int64)]).astype(np.int64) + open_ * np.repeat(batch["lean"].to_numpy(np.int64), lengths)
            seen, which = np.unique(flat, return_inverse=True)
            posterior = latent.posterior(latent.unpacked(seen))[which]
            if not len(flat):
                continue
            expected, has = assigned(posterior, np.cumsum(lengths) - lengths)  # a document here has a sentence
            ids = batch["doc_id"].to_numpy()
            found = [(ids[d], subjects[c], float(expected[d, c])) for d, c in zip(*np.nonzero(has))]
            yield pd.DataFrame(found, columns=["doc_id", "subject", "share"])

    found = full.select("doc_id", "patterns", "lean").mapInPandas(assign, "doc_id string, subject string, share double")
    return found.select(F.col("doc_id").cast(kind).alias("doc_id"), "subject", "share")
