"""Encoding of texts with a public byte-level BPE tokenizer by prefix-sharing trie traversal.

A text is split by the tokenizer's pattern into words; a word's encoding depends on the word alone.  The distinct words of
a batch are inserted into a trie of bytes.  Going down the trie depth first, every node (a prefix) gets its *last token*:
the one token that ends there such that the pair (last token of the prefix before it, it) is left as it is by the merges.
Encodings of shared prefixes are thus computed once, and a word's ids are read off by walking back from its node.  The cost
is linear in the bytes of the trie, also for a word of a million letters.

The trie stays in the Python worker between batches.  Texts are taken in runs of at most ``RUN`` characters (or one text), and
after each run trie and known pairs are dropped where they have reached ``NODES``, so that memory is bounded whatever the
corpus; no word crosses the network.  The driver reads the vocabulary and broadcasts it (under 1 MB); workers need no file.

Defined cases: null and empty texts give an empty list; special tokens' strings are ordinary text; text is taken exactly as
stored, broken and decomposed characters included.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Nodes of a worker's trie (about 250 bytes each), and known pairs, that are kept from one run of texts to the next.
NODES = 400_000
#: Characters of a run.
RUN = 1_000_000
FOLDER = os.environ.get("DECISIONLAKE_TOKENIZERS", "/opt/tokenizers")
# The pattern by which this kind of tokenizer splits a text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TrieEncoder:
    """Ids of words by last-token states on a trie of their bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, nodes: int = NODES) -> None:
        self.ranks, self.nodes = ranks, nodes
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.split = regex.compile(pattern).findall
        self.stable: dict[tuple[int, int], bool] = {}  # pairs of tokens that the merges leave alone, or don't
        self.own = {i for t, i in ranks.items() if len(t) == 1 or len(t) > 1 and self.merged(t) == [i]}
        self.clear()

    def clear(self) -> None:
        # node: its children by byte; the last token and the node where that token begins
        self.children: list[dict[int, int]] = [{}]
        self.last = [-1]
        self.start = [-1]
        self.words: dict[str, list[int]] = {}

    def merged(self, data: bytes) -> list[int]:
        """The ids by merging the lowest-ranked pair again and again; only for what one or two tokens span."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1)))
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def holds(self, a: int, b: int) -> bool:
        """Whether the merges leave the tokens a, b as they are beside one another."""
        key = (a, b)
        known = self.stable.get(key)
        if known is None:
            known = self.stable[key] = self.merged(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def insert(self, data: bytes) -> int:
        """The word's node; prefixes that are there already are shared."""
        node, children, last, start, path = 0, self.children, self.last, self.start, [0]
        for at, byte in enumerate(data):
            after = children[node].get(byte)
            if after is None:
                after = len(children)
                children[node][byte] = after
                children.append({})
                for begin in range(max(0, at + 1 - self.longest), at + 1):  # the longest token first
                    token = self.ranks.get(data[begin : at + 1])
                    if token is not None and token in self.own and (begin == 0 or self.holds(last[path[begin]], token)):
                        last.append(token)
                        start.append(path[begin])
                        break
                else:
                    raise ValueError("no token ends here: the vocabulary lacks a byte")
            path.append(after)
            node = after
        return node

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        out: list[list[int]] = []
        run: list[str | None] = []
        held = 0
        for text in texts:
            if run and held + len(text or "") > RUN:
                out += self._run(run)
                run, held = [], 0
            run.append(text)
            held += len(text or "")
        return out + self._run(run)

    def _run(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.split(t) if t else [] for t in texts]
        fresh = {w for words in split for w in words} - self.words.keys()
        for word in sorted(fresh):  # sorted words run through the trie depth first
            node, ids = self.insert(word.encode("utf-8", "surrogatepass")), []
            while node > 0:
                ids.append(self.last[node])
                node = self.start[node]
            self.words[word] = ids[::-1]
        known = self.words
        out = [[i for w in words for i in known[w]] for words in split]
        if len(self.children) > self.nodes:
            self.clear()
        if len(self.stable) > self.nodes:
            self.stable.clear()
        return out


@lru_cache(maxsize=2)
def encoder(vocabulary: bytes) -> TrieEncoder:
    """The encoder of a vocabulary, lines of base64 tokens and ranks, once per worker."""
    return TrieEncoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())})


def token_ids(texts: DataFrame, identifier: str, text: str, path: str | None = None) -> DataFrame:
    """``identifier, ids`` for every row, without a shuffle."""
    with open(path or os.path.join(FOLDER, "byte_bpe_50k.tiktoken"), "rb") as file:
        shared = texts.sparkSession.sparkContext.broadcast(file.read())
    kind = texts.schema[identifier].dataType.simpleString()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = encoder(shared.value)
        for batch in batches:
            found = [None if t is None or t != t else t for t in batch[text].tolist()]
            yield pd.DataFrame({identifier: batch[identifier], "ids": ids.encode(found)})

    # ids travel as text: whole numbers beside nulls would come as floating point
    named = texts.select(F.col(identifier).cast("string").alias(identifier), text)
    return named.mapInPandas(encode, f"`{identifier}` string, ids array<int>").select(F.col(identifier).cast(kind).alias(identifier), "ids")
