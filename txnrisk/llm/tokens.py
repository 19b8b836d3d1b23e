"""Token counts by a unigram vocabulary, with the forward scores shared in a trie.

A text is split into words; each word, with the space mark in front, is cut into the pieces whose
scores add up to most. The best score of a prefix depends on the prefix alone, so the distinct words
of a batch that a task has not met yet are put in a trie, every node is worked out once, and a
word's count is read at its last node and kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnrisk.llm import common
from txnrisk.llm.common import by_value

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words whose counts a task keeps; beyond that it starts anew, which changes no count.
MOST_WORDS = 400_000
#: Words put in one trie, and the most characters of such a word; longer ones are worked out alone.
TRIE_WORDS = 40_000
LONGEST = 64
#: Bytes of text whose words a task holds split at a time.
STEP_BYTES = 8 << 20


def load_vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces and their log scores, from a model file read on the driver.

    A vocabulary of merges has ranks (0, -1, -2 ...) for scores, not probabilities; they are read by
    Zipf's law, as probabilities in proportion to 1 / (1 + rank). Control, byte and unknown pieces
    are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    raw = {model.id_to_piece(i): model.get_score(i) for i in usual}
    if all(x <= 0 and x == int(x) for x in raw.values()):
        return {piece: -math.log(1.0 - x) for piece, x in raw.items()}
    return raw


class Backwards:
    """The pieces spelled backwards as an automaton: from a state, by a character, to a state."""

    def __init__(self, scores: dict[str, float]):
        step: dict[tuple[int, str], int] = {}
        score = [-math.inf]
        for piece, value in scores.items():
            state = 0
            for character in reversed(piece):
                following = step.get((state, character))
                if following is None:
                    following = step[state, character] = len(score)
                    score.append(-math.inf)
                state = following
            if state:
                score[state] = value
        keys = np.array([(state << 21) | ord(c) for state, c in step] or [0], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.to = keys[order], np.array(list(step.values()) or [0], dtype=np.int64)[order]
        self.score = np.array(score)
        self.byte = min(scores.values(), default=0.0) - 10.0

    def among(self, alphabet: np.ndarray):
        """The step function for texts of these characters, which are given as places in the alphabet.

        State 0 stands for no such state. For usual alphabets the steps are a dense table.
        """
        if len(alphabet) <= 256:
            at = np.searchsorted(alphabet, self.keys & 0x1FFFFF)
            known = alphabet[np.minimum(at, len(alphabet) - 1)] == self.keys & 0x1FFFFF
            dense = np.zeros((len(self.score), len(alphabet)), dtype=np.int32)
            dense[self.keys[known] >> 21, at[known]] = self.to[known]
            flat = dense.ravel()
            return lambda state, letter: flat.take(state * len(alphabet) + letter)

        def follow(state, letter):
            key = (state << 21) | alphabet[letter]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            return np.where(self.keys[at] == key, self.to[at], 0)

        return follow


def trie_counts(words: list[str], pieces: Backwards) -> np.ndarray:
    """Pieces in the best cut of each of the words, which are distinct and in order of code points.

    Sorted words are a trie: a node of depth d is a run of words with the same d characters, and
    its first word stands for it. Level by level the best score and the count of every node follow
    from those of its ancestors; a word's count is that of its last node. Among cuts of equal
    score the one with fewer pieces counts. A character that is no piece is spelled as its UTF-8
    bytes, each scoring 10 less than the lowest piece.
    """
    n = len(words)
    length = np.fromiter(map(len, words), dtype=np.int64, count=n)
    width = int(length.max(initial=0))
    characters = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    alphabet = np.unique(characters)
    follow = pieces.among(alphabet)
    letters = np.full((n, width), -1, dtype=np.int64)
    letters[np.arange(width) < length[:, None]] = np.searchsorted(alphabet, characters)
    new = np.ones((n, width), dtype=bool)
    if n > 1:
        np.logical_or.accumulate(letters[1:] != letters[:-1], axis=1, out=new[1:])
    score, count = np.zeros((width + 1, n)), np.zeros((width + 1, n), dtype=np.int64)
    rows = np.arange(n)
    letters = np.ascontiguousarray(letters.T)
    for depth in range(1, width + 1):
        nodes = np.flatnonzero(new[:, depth - 1] & (length >= depth))
        best, fewest = np.full(len(nodes), -np.inf), np.zeros(len(nodes), dtype=np.int64)

        def offer(which, start, gain, pieces_more):
            at = nodes[which]
            total, m = score[start, at] + gain, count[start, at] + pieces_more
            better = (total > best[which]) | ((total == best[which]) & (m < fewest[which]))
            best[which[better]], fewest[which[better]] = total[better], m[better]

        last = letters[depth - 1, nodes]
        live, state = np.arange(len(nodes)), np.zeros(len(nodes), dtype=np.int64)
        for start in range(depth - 1, -1, -1):
            state = follow(state, letters[start].take(nodes.take(live)))
            on = np.flatnonzero(state)
            live, state = live.take(on), state.take(on)
            if not len(live):
                break
            gain = pieces.score.take(state)
            piece = np.flatnonzero(gain > -np.inf)
            offer(live.take(piece), start, gain.take(piece), 1)
        alone = pieces.score[follow(np.zeros(len(nodes), dtype=np.int64), last)] > -np.inf
        spelled = np.flatnonzero(~alone)
        code = alphabet[last[spelled]]
        n_bytes = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        offer(spelled, depth - 1, pieces.byte * n_bytes, n_bytes)
        first = np.maximum.accumulate(np.where(new[:, depth - 1], rows, 0))
        score[depth, nodes], count[depth, nodes] = best, fewest
        score[depth], count[depth] = score[depth, first], count[depth, first]
    return count[length, rows]


def long_count(word: str, pieces: Backwards) -> int:
    """The same for a single word of any length, in memory that is in proportion to it."""
    step = dict(zip(pieces.keys.tolist(), pieces.to.tolist()))
    path = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        best, state = (-math.inf, 0), 0
        for start in range(end - 1, -1, -1):
            state = step.get((state << 21) | ord(word[start]), 0)
            if not state:
                break
            if pieces.score[state] > -math.inf:
                before, m = path[start]
                best = max(best, (before + pieces.score[state], -m - 1))
        if pieces.score[step.get(ord(word[end - 1]), 0)] == -math.inf:
            n_bytes = len(word[end - 1].encode("utf-8"))
            before, m = path[end - 1]
            best = max(best, (before + pieces.byte * n_bytes, -m - n_bytes))
        path.append((best[0], -best[1]))
    return path[-1][1]


class Counts(dict):
    """Pieces of each word, given as UTF-8, that a task has met."""

    def __init__(self, scores: dict[str, float], most_words: int = MOST_WORDS):
        super().__init__()
        self.pieces, self.most_words = Backwards(scores), most_words

    def meet(self, words: set[bytes]) -> None:
        """Work out the words not met yet, after which all of the given ones are there."""
        raw = sorted(words.difference(self))
        if len(self) + len(raw) > self.most_words:
            self.clear()
            raw = sorted(words)
        spelled = [MARK + w for w in b"\n".join(raw).decode("utf-8").split("\n")] if raw else []
        usual = [i for i, s in enumerate(spelled) if len(s) <= LONGEST]
        for at in range(0, len(usual), TRIE_WORDS):
            part = usual[at : at + TRIE_WORDS]
            counts = trie_counts([spelled[i] for i in part], self.pieces)
            self.update(zip((raw[i] for i in part), counts.tolist()))
        for w, s in zip(raw, spelled):
            if len(s) > LONGEST:
                self[w] = long_count(s, self.pieces)


def count_tokens(docs: DataFrame, scores: dict[str, float], key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_words, n_tokens) of every whole text; null and blank texts have 0 tokens.

    Words are runs of other than ASCII white space. Repeated rows are counted each. The vocabulary
    is fixed, and small enough to broadcast; one pass, nothing is shuffled.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(scores)
    schema = common.schema_of(f"{key} {docs.schema[key].dataType.simpleString()}, n_bytes long, n_words long, n_tokens long")

    def count(batches):
        counts = Counts(shipped.value)
        for batch in batches:
            texts = common.texts_of(batch.column(1))
            sizes, words, tokens = [len(t) for t in texts], [], []
            at = 0
            while at < len(texts):  # as many texts at once as hold about STEP_BYTES
                end, held = at, 0
                while end < len(texts) and (end == at or held + sizes[end] <= STEP_BYTES):
                    held += sizes[end]
                    end += 1
                split = [t.split() for t in texts[at:end]]
                counts.meet(set().union(*split))
                words += map(len, split)
                tokens += (sum(map(counts.__getitem__, w)) for w in split)
                at = end
            arrays = [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, words, tokens))]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])

    return docs.select(key, "text").mapInArrow(count, schema)


by_value(__name__)
