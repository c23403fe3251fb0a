"""Token counts under a unigram model, by dynamic programming over a trie of the distinct words."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicloom.llm.common import text_chunks, word_codes
from topicloom.llm.packing import vocabulary_path

# Pieces get the probability of their rank under a Zipf-Mandelbrot law: the vocabulary file has ranks but no frequencies.
ZIPF_SHIFT = 2.7
ZIPF_POWER = 1.0


class PieceTrie:
    """The pieces of a vocabulary as a trie in sorted arrays: state and byte lead to a state, some states end a piece."""

    def __init__(self, scores: dict[bytes, float]):
        step: dict[int, int] = {}
        ends: dict[int, float] = {}
        for piece, score in scores.items():
            state = 0
            for byte in piece:
                state = step.setdefault(state << 8 | byte, len(step) + 1)
            ends[state] = score
        self.keys = np.array(sorted(step), np.int64)
        self.to = np.array([step[k] for k in sorted(step)], np.int64)
        self.score = np.full(len(step) + 1, -np.inf)
        for state, score in ends.items():
            self.score[state] = score

    def advance(self, states: np.ndarray, octets: np.ndarray) -> np.ndarray:
        """The states after one more byte; -1 where no piece goes on."""
        wanted = states << 8 | octets
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.to[at], -1)


def zipf_scores(path: str, power: float = ZIPF_POWER, shift: float = ZIPF_SHIFT) -> dict[bytes, float]:
    """The log-probability of each piece of a rank file."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    raw = {piece: -power * np.log(rank + shift) for piece, rank in ranks.items()}
    total = np.log(sum(np.exp(x) for x in raw.values()))
    return {piece: float(x - total) for piece, x in raw.items()}


def best_splits(words: list[bytes], trie: PieceTrie) -> tuple[np.ndarray, np.ndarray]:
    """For each word the score of its best split into pieces and the number of pieces (fewest among equal scores).

    The words form a trie, taken level by level. What is known at a node, the best score and count of its prefix and
    how far pieces begun at each earlier place have come, is computed once however many words go on from there. Words
    need not differ. A byte that is no piece would leave a word without a split, at minus infinity.
    """
    order = sorted(range(len(words)), key=words.__getitem__)
    lined = [words[i] for i in order]
    lengths = np.array([len(w) for w in lined], np.int64)
    scores, counts = np.zeros(len(words)), np.zeros(len(words), np.int64)
    flat = np.frombuffer(b"".join(lined), np.uint8)
    begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    # Whether a word agrees so far with the one before it, which then shares its node.
    alike = np.ones(len(lined), bool)
    alike[:1] = False
    live = np.arange(len(lined))
    # One node so far, the empty prefix: its score and count, and a piece that may begin here.
    node = np.zeros(len(lined), np.int64)
    pair_node, pair_state, pair_score, pair_count = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64)
    level = 0
    while True:
        inside = lengths[live] > level
        # A word is on the same node as the word before it while all bytes so far agree.
        alike, node, live = alike[inside], node[inside], live[inside]
        if not len(live):
            break
        octet = flat[begins[live] + level].astype(np.int64)
        # The word before has to reach this level as well; a shorter one in between ends the agreement.
        alike &= np.concatenate([[False], np.diff(np.flatnonzero(inside)) == 1])
        alike[1:] &= octet[1:] == octet[:-1]
        child = np.cumsum(~alike) - 1
        first = np.flatnonzero(~alike)
        parent, byte = node[first], octet[first]
        # Every piece under way at the parent goes on to the child by the child's byte.
        start = np.searchsorted(pair_node, parent)
        wide = np.searchsorted(pair_node, parent, side="right") - start
        at = np.repeat(start - np.concatenate([[0], np.cumsum(wide)[:-1]]), wide) + np.arange(wide.sum())
        state = trie.advance(pair_state[at], np.repeat(byte, wide))
        to = np.repeat(np.arange(len(first)), wide)
        going = state >= 0
        to, state, at = to[going], state[going], at[going]
        from_score, from_count = pair_score[at], pair_count[at]
        total = from_score + trie.score[state]
        best, fewest = np.full(len(first), -np.inf), np.zeros(len(first), np.int64)
        np.maximum.at(best, to, total)
        top = np.flatnonzero((total == best[to]) & (total > -np.inf))
        fewest[:] = np.iinfo(np.int64).max
        np.minimum.at(fewest, to[top], from_count[top] + 1)
        fewest[best == -np.inf] = 0
        level += 1
        ended = lengths[live] == level
        scores[live[ended]], counts[live[ended]] = best[child[ended]], fewest[child[ended]]
        node = child
        # A new piece may begin at every node that a split reaches.
        fresh = np.flatnonzero(best > -np.inf)
        pair_node = np.concatenate([to, fresh])
        line = np.argsort(pair_node, kind="stable")
        pair_node = pair_node[line]
        pair_state = np.concatenate([state, np.zeros(len(fresh), np.int64)])[line]
        pair_score = np.concatenate([from_score, best[fresh]])[line]
        pair_count = np.concatenate([from_count, fewest[fresh]])[line]
    back_scores, back_counts = np.empty_like(scores), np.empty_like(counts)
    back_scores[order], back_counts[order] = scores, counts
    return back_scores, back_counts


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_words, n_tokens, score for every row of ``docs``.

    Words are runs of anything but ASCII white space and carry one leading blank, as the pieces do. A word takes the
    split of largest probability; ``n_tokens`` and ``score`` (log-probability) are sums over the words of the text. Null
    and blank texts have none. Rows are independent: repeated rows and null ids are kept, other columns ignored. The words
    of a few megabytes of text share one trie at a time, so memory does not grow with the table.
    """
    ranks = path or vocabulary_path()
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PieceTrie(zipf_scores(ranks))
        for batch in text_chunks(batches):
            rows, codes, words = word_codes(batch.column("text"), lower=False)
            scores, counts = best_splits([b" " + w for w in words], trie) if words else (np.zeros(0), np.zeros(0, np.int64))
            n = batch.num_rows
            total = np.bincount(rows, weights=scores[codes], minlength=n) if len(rows) else np.zeros(n)
            tokens = np.bincount(rows, weights=counts[codes], minlength=n) if len(rows) else np.zeros(n)
            number = np.bincount(rows, minlength=n) if len(rows) else np.zeros(n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(number.astype(np.int64)), pa.array(tokens.astype(np.int64)), pa.array(total)], names=["doc_id", "n_words", "n_tokens", "score"])

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(count, f"doc_id {kind}, n_words long, n_tokens long, score double")
