"""LM scoring by online logistic context mixing.

A text is a sequence of words and an end. Each token is coded by binary decisions, every one predicted by several
hashed contexts whose votes are mixed in the logistic domain with weights that a gate selects:

* Does the token follow its predecessor as it did before in this text? Contexts: the run of such hits, the predecessor,
  how often it was seen; the text's own rate so far. The weights are refined online within the text.
* Does the token follow its predecessor as it did in another text of the corpus? Inputs: how often the predecessor occurs
  in other texts, the text's own rate so far; weights by the run of such tokens, refined online. The pairs of neighbours are
  counted over the whole corpus, and a training text's own are left out for itself.
* Does the token come from the corpus dictionary or is it spelled out? The corpus rate and the text's own, mixed alike.
* The bits of a spelled word: contexts of one to six preceding bytes, hashed into tables of counts over the corpus
  vocabulary; weights learned online over the vocabulary, gated by how many contexts are sure and the bit's place;
  an adaptive probability map refines the result.

A token that follows as elsewhere costs its share of what follows the predecessor there. A dictionary token costs its share of
the training tokens of texts of one kind: kinds are clusters of all training texts
(languages, for instance), and how much each kind counts follows from the text so far. All ways to code a token add up, so the
score is the probability of the text. Words and their counts are gathered over the whole corpus: texts are tokenised in blocks of
bounded size with a dictionary each, dictionaries meet the corpus counts in a join, and blocks meet their dictionaries. A block's
pairs travel as sorted hashes, dealt out by their first bits; what the other blocks have of them comes back in the same order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazegrid.llm.common import keep

#: Bytes of text in a block, about.
BLOCK_BYTES = 32 << 20
#: Bytes of context, slots of each one's table (a power of two), steps of the probability map.
ORDERS, SLOT_BITS, MAP_STEPS = (1, 2, 3, 4, 6), 19, 33
#: Words of the vocabulary that one task learns from, about.
TASK_WORDS = 400_000
#: A byte is five bits (a letter, the end of the word, or the two high bits of any other) and for others six more.
CODE_BITS, NODES = 11, 32 + 4 * 64
GATES = (len(ORDERS) + 1) * CODE_BITS
_PAD = max(ORDERS)
#: Slots for runs of hits, predecessors, and sightings.
RUNS, BEFORE, SEEN = 16, 4096, 16
HIT_SLOTS = RUNS + BEFORE + SEEN
#: Kinds of text, hashed words of a text's profile (a power of two), texts whose profiles are made at a time.
KINDS, PROFILE, SLICE_TEXTS = 6, 1024, 256
#: Passes that draw candidates for centres, candidates of a pass, passes that move the centres.
SEED_PASSES, CANDIDATES, MOVES = 2, 32, 3
#: Bytes of text for which a part of the pairs is made, bits of the number of parts at most, bits of a pair's hash in its part.
PAIR_BYTES, PART_BITS, PAIR_BITS = 16 << 20, 14, 28
#: Rows of the blocks' dictionaries that a task packs at a time.
PACK_ROWS = 400_000
#: Runs of tokens that followed as elsewhere; weights of that decision at the start: predecessor's count, text's rate, bias.
FOLLOWS, FOLLOW_START = 4, np.array([0.2, 0.5, -0.2])
#: Tokens of a text between two refinements of its weights.
STRIDE = 32
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# ---- spelling -------------------------------------------------------------------------------------------------------

def _positions(words: list[bytes], most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Padded bytes, the places of the bytes to predict (each word ends with a space) and their words, in bounded pieces."""
    buf = np.frombuffer(b"".join(bytes(_PAD) + w + b" " for w in words) + b" ", np.uint8)
    size = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
    start = np.cumsum(size + _PAD) - size
    of = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    for i in range(0, len(at), most):
        yield buf, at[i:i + most], of[i:i + most]


def _contexts(buf: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    out, h = [], np.zeros(len(at), np.uint64)
    for back in range(1, _PAD + 1):
        h = (h + buf[at - back].astype(np.uint64) + np.uint64(1)) * _C1
        if back in ORDERS:
            out.append(h ^ (h >> np.uint64(29)))
    return out


def _different(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One place of each byte with its contexts among ``at``, which of these each place equals, and how many do. What a
    byte costs and counts follows from them, so it is worked out once."""
    key = np.lib.stride_tricks.sliding_window_view(buf, 8)[at - _PAD].view("<u8")[:, 0] << np.uint64(8 * (7 - _PAD))
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    of = np.empty(len(at), np.int64)
    of[order] = np.cumsum(new) - 1
    return at[order[new]], of, np.diff(np.append(np.flatnonzero(new), len(at)))


def _code() -> np.ndarray:
    """The eleven bits of every byte."""
    code = np.array([((27 + (b >> 6)) << 6) | (b & 63) for b in range(256)])
    code[32] = 0
    code[97:123] = np.arange(1, 27) << 6
    return code


_CODE = _code()
_SHORT = _CODE < 27 << 6


def _bits(buf: np.ndarray, at: np.ndarray, contexts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray | slice, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each bit of the code: its place, which bytes have it, the node of the code tree, its value, the contexts' slots."""
    byte = buf[at]
    code, pick = _CODE[byte], slice(None)
    for k in range(CODE_BITS):
        if k == 5:
            pick = np.flatnonzero(~_SHORT[byte])
            if not len(pick):
                return
            code, contexts = code[pick], [c[pick] for c in contexts]
        node = (1 << k) | (code >> (CODE_BITS - k)) if k < 5 else 32 + ((code >> 6) - 27) * 64 + ((1 << (k - 5)) | ((code & 63) >> (CODE_BITS - k)))
        mixed = node.astype(np.uint64) * _C2
        yield k, pick, node, (code >> (CODE_BITS - 1 - k)) & 1, [(((c + mixed) * _C1) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for c in contexts]


def spelling_counts(words: list[bytes], counts: np.ndarray) -> None:
    """Adds the bits of the words to counts[order, slot, bit]."""
    flat = counts.reshape(len(ORDERS), -1)
    for buf, at, _ in _positions(words):
        found: list[list[np.ndarray]] = [[] for _ in ORDERS]
        at, _, many = _different(buf, at)
        times = []
        for _, pick, _, bit, slots in _bits(buf, at, _contexts(buf, at)):
            times.append(many[pick])
            for o, s in enumerate(slots):
                found[o].append(s * 2 + bit)
        weight = np.concatenate(times)
        for o, s in enumerate(found):
            flat[o] += np.bincount(np.concatenate(s), weight, flat.shape[1]).astype(counts.dtype)


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _map_cell(node: np.ndarray, s: np.ndarray) -> np.ndarray:
    return node * MAP_STEPS + np.clip(np.rint(s * 2) + MAP_STEPS // 2, 0, MAP_STEPS - 1).astype(np.int64)


@dataclass
class Spelling:
    """counts[order, slot, bit], weights[gate, order], and the probability map as counts[bit, cell]."""
    counts: np.ndarray
    weights: np.ndarray
    cells: np.ndarray

    @staticmethod
    def fresh(counts: np.ndarray | None = None) -> Spelling:
        return Spelling(np.zeros((len(ORDERS), 1 << SLOT_BITS, 2), np.float32) if counts is None else counts,
                        np.full((GATES, len(ORDERS)), 0.35), np.zeros((2, NODES * MAP_STEPS)))

    def learning_tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Stretched probability of every slot for a word of its own counts, which is left out of them: at 2 * slot + its
        bit. And whether the slot is sure."""
        x, sure = np.empty(self.counts.shape, np.float32), np.empty(self.counts.shape[:2], np.int8)
        for o, (zeros, ones) in enumerate(np.moveaxis(self.counts, 2, 1)):
            for bit in (0, 1):
                x[o, :, bit] = np.log((np.maximum(ones - bit, 0) + np.float32(0.4)) / (np.maximum(zeros - (1 - bit), 0) + np.float32(0.4)))
            sure[o] = zeros + ones >= 2
        return x.reshape(len(ORDERS), -1), sure

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Stretched probability of every slot, and whether it is sure."""
        zeros, ones = self.counts[..., 0], self.counts[..., 1]
        return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4))), (zeros + ones >= 2).astype(np.int8)

    def learn(self, words: list[bytes], rate: float = 0.1, batch: int = 16_384, tables: tuple[np.ndarray, np.ndarray] | None = None) -> int:
        """One online pass over words of the vocabulary: weights by gradient steps after each batch, and the map. Returns the
        bits seen. ``tables``: those of ``learning_tables``, if they are at hand."""
        speed, bits = np.full(self.weights.shape, 1.0), 0
        tables = tables or self.learning_tables()
        for buf, at, _ in _positions(words):
            for i in range(0, len(at), batch):
                part, _, many = _different(buf, at[i:i + batch])
                for k, pick, node, bit, slots in _bits(buf, part, _contexts(buf, part)):
                    times = many[pick]
                    x, sure = np.empty((len(ORDERS), len(node)), np.float32), np.zeros(len(node), np.int8)
                    for o, s in enumerate(slots):
                        x[o] = tables[0][o].take(s * 2 + bit)
                        sure += tables[1][o].take(s)
                    gate = sure.astype(np.int64) * CODE_BITS + k
                    s = np.einsum("no,on->n", self.weights.astype(np.float32)[gate], x)
                    wrong = (bit - _squash(s)) * times
                    step = np.stack([np.bincount(gate, wrong * v, GATES) for v in x], 1)
                    speed += step * step
                    self.weights += rate * step / np.sqrt(speed)
                    cell = _map_cell(node, s)
                    both = np.bincount(cell * 2 + bit, times, 2 * self.cells.shape[1])
                    self.cells += both.reshape(-1, 2).T
                    bits += int(times.sum())
        return bits

    def _chances(self, tables: tuple[np.ndarray, np.ndarray], k: int, node: np.ndarray, slots: list[np.ndarray]) -> np.ndarray:
        """Probability that the bit is 1."""
        x, sure = np.empty((len(ORDERS), len(node)), np.float32), np.zeros(len(node), np.int8)
        for o, s in enumerate(slots):
            x[o] = tables[0][o].take(s)
            sure += tables[1][o].take(s)
        s = np.einsum("no,on->n", self.weights.astype(np.float32)[sure.astype(np.int64) * CODE_BITS + k], x)
        p, cell = _squash(s), _map_cell(node, s)
        refined = (self.cells[1][cell] + 16 * p) / (self.cells[0][cell] + self.cells[1][cell] + 16)
        return np.clip((p + 3 * refined) / 4, 1e-6, 1 - 1e-6)

    def cost(self, words: list[bytes], tables: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Natural logarithm of each word's probability, with its end. ``tables``: those of ``tables()``, if they are at hand."""
        out, tables = np.zeros(len(words)), tables or self.tables()
        for buf, at, of in _positions(words):
            at, same, _ = _different(buf, at)
            total = np.zeros(len(at))
            for k, pick, node, bit, slots in _bits(buf, at, _contexts(buf, at)):
                p = self._chances(tables, k, node, slots)
                total[pick] += np.log(np.where(bit == 1, p, 1 - p))
            out += np.bincount(of, total[same], len(words))
        return out


# ---- decisions within a text ----------------------------------------------------------------------------------------

@dataclass
class Tokens:
    """All tokens of a block: word numbers and the text each belongs to, with what the hit decision sees."""
    word: np.ndarray
    text: np.ndarray
    tried: np.ndarray      # the predecessor was seen before in the text
    hit: np.ndarray        # and the token after it was this one
    slots: np.ndarray      # three per token, of the corpus table of hits
    rate: np.ndarray       # stretched rate of hits in the text so far
    run: np.ndarray


def _before(x: np.ndarray, first: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Sum of x over the earlier tokens of the same text."""
    total = np.concatenate(([0], np.cumsum(x)))
    return total[:-1] - total[first][text]


def _order(x: np.ndarray, most: int) -> np.ndarray:
    """A stable order of whole numbers from 0 to ``most``: plain sorts of value and place in one number are the fastest."""
    bits = len(x).bit_length()
    if most.bit_length() + bits > 63:
        return np.argsort(x, kind="stable")
    return np.sort((x.astype(np.int64) << bits) | np.arange(len(x))) & ((1 << bits) - 1)


def look_back(texts: list[np.ndarray], mark: np.ndarray) -> Tokens:
    """``mark``: a hash of each word of the block."""
    size = np.array([len(t) for t in texts], np.int64)
    word = np.concatenate(texts).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts)), size)
    first = np.cumsum(size) - size
    n = len(word)
    key = text * (int(word.max(initial=0)) + 1) + word
    order = _order(key, len(texts) * (int(word.max(initial=0)) + 1))
    key = key[order]
    same = key[1:] == key[:-1]
    earlier = np.full(n, -1, np.int64)          # the last place of the same word in the text
    earlier[order[1:][same]] = order[:-1][same]
    place = np.arange(n)
    group = np.concatenate(([True], ~same)) if n else np.zeros(0, bool)
    times = np.zeros(n, np.int64)               # how often the word came before in the text
    times[order] = place - np.maximum.accumulate(np.where(group, place, 0)) if n else place
    prev = np.where(place > first[text], place - 1, 0) if n else place
    last = np.where(place > first[text], earlier[prev], -1) if n else place
    tried = last >= 0
    hit = tried & (word[np.where(tried, last + 1, 0)] == word) if n else tried
    miss = np.maximum.accumulate(np.where(hit, -1, place)) if n else place
    ended = np.maximum(np.where(hit, miss, place), first[text] - 1) if n else place   # the last place that was no hit
    after = place - ended                        # hits up to and with this token
    run = np.where(place > first[text], after[prev], 0) if n else place
    tries, hits = _before(tried, first, text), _before(hit, first, text)
    was_hit = np.where(place > first[text], hit[prev], False) if n else tried
    slots = np.stack([np.minimum(run, RUNS - 1), RUNS + mark[word[prev]] % BEFORE if n else place,
                      RUNS + BEFORE + np.minimum(times[prev], 7) * 2 + was_hit]) if n else np.zeros((3, 0), np.int64)
    return Tokens(word, text, tried, hit, slots, np.log((hits + 0.4) / (tries - hits + 1.6)), np.minimum((run + 2) // 3, 2))


def _neighbours(texts: list[np.ndarray], crc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The place before each token (before a text's first one stands its end) and a hash of both words, its part in front."""
    word, size = np.concatenate(texts), np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    before = np.arange(-1, len(word) - 1)
    before[end - size] = end - 1
    mark = crc[word].astype(np.uint64)
    h = ((mark[before] << np.uint64(32)) | mark) * _C1
    h = (h ^ (h >> np.uint64(29))) * _C2
    return before, (h ^ (h >> np.uint64(32))) >> np.uint64(64 - PAIR_BITS - bits)


def block_pairs(texts: Iterable[np.ndarray], held: Iterable[bool], crc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of neighbours of a block, by their hashes, and how often its training texts have each."""
    texts, held = list(texts), list(held)

    # the lowest bit says whether the pair is of a training text, so one sort tells both the pairs and their counts
    found = [_neighbours(part, crc, bits)[1] << np.uint64(1) | np.uint64(not these)
             for these in (False, True) for part in _slices(t for t, h in zip(texts, held) if h == these)]
    key = np.concatenate(found) if found else np.zeros(0, np.uint64)
    key.sort()
    trained = key & np.uint64(1)
    key >>= np.uint64(1)
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    times = np.add.reduceat(trained, start) if len(key) else trained
    return key[start], times.astype(np.uint32)


@dataclass
class Followers:
    """What other training texts have of each token's predecessor, and of the predecessor with the token behind it."""
    all: np.ndarray
    same: np.ndarray

    @staticmethod
    def of(texts: list[np.ndarray], tokens: Tokens, held: np.ndarray, count: np.ndarray, crc: np.ndarray, bits: int, pairs: np.ndarray,
           times: np.ndarray) -> Followers:
        """``pairs`` and ``times``: hashes of the block's pairs and their counts in all training texts."""
        before, key = _neighbours(texts, crc, bits)
        trained = ~held[tokens.text]

        def groups(of: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """An order of places by value, where each value begins in it, and how often it occurs."""
            order = _order(of, most)
            of = of[order]
            start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            return order, start, np.diff(np.append(start, len(of)))

        def own(of: np.ndarray, many: int) -> np.ndarray:
            order, _, n = groups(tokens.text * many + of, len(texts) * many)
            out = np.empty(len(of), np.int64)
            out[order] = np.repeat(n, n)
            return out

        order, start, n = groups(key, 1 << (PAIR_BITS + bits))
        number, total = np.empty(len(key), np.int64), np.empty(len(key))
        number[order] = np.repeat(np.arange(len(start)), n)
        total[order] = np.repeat(times[np.searchsorted(pairs, key[order[start]])], n)
        whole = count[tokens.word] - trained * own(tokens.word, len(count))
        return Followers(np.maximum(whole[before], 0), np.maximum(total - trained * own(number, len(start)), 0.0))


def follow_costs(tokens: Tokens, texts: int, found: Followers, total: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``total`` (the logarithm of each token's probability otherwise) with the chance that a token follows as elsewhere."""
    tried, hit = found.all > 0, found.same > 0
    at = np.flatnonzero(tried)
    if not len(at):
        return total
    tries, hits = _before(tried, first, tokens.text), _before(tried & hit, first, tokens.text)
    place = np.arange(len(hit))
    ended = np.maximum(np.maximum.accumulate(np.where(hit, -1, place)), first[tokens.text] - 1)
    run = np.where(place > first[tokens.text], (place - ended)[place - 1], 0)   # hits up to the token before
    x = np.stack([np.log(found.all[at]), np.log((hits[at] + 1.0) / (tries[at] - hits[at] + 1.0)), np.ones(len(at))])
    p = online_mix(x, np.minimum((run[at] + 2) // 3, FOLLOWS - 1), FOLLOWS, hit[at].astype(float), tokens.text[at], texts, FOLLOW_START)
    p = np.clip(p, 1e-6, 1 - 1e-6)
    out, share = total.copy(), found.same[at] / found.all[at]
    out[at] = np.where(hit[at], np.log(p * np.minimum(share, 1) + (1 - p) * np.exp(total[at])), np.log1p(-p) + total[at])
    return out


def _slices(texts: Iterable[np.ndarray], most: int = 1 << 16) -> Iterator[list[np.ndarray]]:
    """Runs of texts with about ``most`` tokens: a block's texts are scored run by run, which bounds the arrays made for
    them by the longest text, not by the block."""
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _renumbered(texts: list[np.ndarray], words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The texts by numbers of the words they have among ``words``, and these words."""
    own = np.flatnonzero(np.bincount(np.concatenate(texts), minlength=words))
    number = np.zeros(words, np.int32)
    number[own] = np.arange(len(own))
    return [number[t] for t in texts], own


def online_mix(x: np.ndarray, gate: np.ndarray, gates: int, y: np.ndarray, text: np.ndarray, texts: int, start: np.ndarray,
               rate: float = 0.02) -> np.ndarray:
    """Probability of y = 1 for each decision, from inputs x (inputs x decisions) mixed with weights per text and gate.

    Decisions of a text stand in order. Weights begin at ``start``; after every STRIDE decisions of a text they take a
    gradient step, so a decision is predicted from those before it only. All texts advance together.
    """
    size = np.bincount(text, minlength=texts)
    order = np.argsort(-size, kind="stable")     # long texts first: the active ones are always a prefix
    first = (np.cumsum(size) - size)[order]
    size = size[order]
    live = np.searchsorted(-size, -np.arange(0, int(size.max(initial=0)), STRIDE), side="left")
    # All strides one after the other, each with its active texts, filled up to their full length
    turn = np.repeat(np.arange(len(live)), live)
    rank = np.arange(len(turn)) - np.repeat(np.cumsum(live) - live, live)
    place = (first[rank] + turn * STRIDE)[:, None] + np.arange(STRIDE)
    real = np.arange(STRIDE) < (size[rank] - turn * STRIDE)[:, None]
    place = np.where(real, place, 0)
    v, y = x[:, place], y[place]
    row = rank[:, None] * gates + gate[place] if gates > 1 else None
    p = np.empty(place.shape)
    weights = np.tile(start, (texts * gates, 1)).T.copy()
    end = 0
    for many in live.tolist():
        now = slice(end, end + many)
        end += many
        if gates == 1:
            s = np.einsum("it,its->ts", weights[:, :many], v[:, now])
        else:
            s = sum(w.take(row[now]) * u for w, u in zip(weights, v[:, now]))
        p[now] = _squash(s)
        wrong = (y[now] - p[now]) * real[now]
        if gates == 1:
            weights[:, :many] += rate * np.einsum("ts,its->it", wrong, v[:, now])
        else:
            of = row[now].reshape(-1)
            for w, u in zip(weights, v[:, now]):
                w[:many * gates] += rate * np.bincount(of, (wrong * u).reshape(-1), many * gates)
    out = np.empty(x.shape[1])
    out[place[real]] = p[real]
    return out


def dictionary_chances(tokens: Tokens, count: np.ndarray, shares: np.ndarray, kind_tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each token's dictionary probability (0 if it is not listed), from the words' counts and the shares of each kind in
    them (in 255ths). The kinds are weighed by how well each has predicted the text so far."""
    n = kind_tokens.sum()
    if not n:
        return np.zeros(len(tokens.word))
    of = kind_tokens[:, None]
    p = 0.95 * np.where(of > 0, count * (shares.T / 255) / np.maximum(of, 1), count / n) + 0.05 * count / n
    belief = np.log(np.where(count > 0, p, 1)).take(tokens.word, axis=1)
    for k, x in enumerate(belief):
        x[:] = np.log((kind_tokens[k] + 1) / (n + len(kind_tokens))) + _before(x, first, tokens.text)
    belief = np.exp(belief - belief.max(0))
    return np.einsum("kt,kt->t", belief, p.take(tokens.word, axis=1)) / belief.sum(0)


def text_costs(tokens: Tokens, texts: int, count: np.ndarray, shares: np.ndarray, spelled: np.ndarray, kind_tokens: np.ndarray,
               single: int, hits: np.ndarray, found: Followers | None = None) -> np.ndarray:
    """Natural logarithm of each text's probability. ``count``, ``shares`` (words x kinds) and ``spelled`` by word;
    ``single``: words seen once in training; ``hits``: corpus counts [miss/hit, slot]; ``found``: what follows in other texts."""
    n = int(kind_tokens.sum())
    known = count[tokens.word] > 0
    first = np.cumsum(np.bincount(tokens.text, minlength=texts)) - np.bincount(tokens.text, minlength=texts)
    ones = _before(known, first, tokens.text)
    seen = np.arange(len(tokens.word)) - first[tokens.text]
    rate = np.log((n - single + 0.5) / (single + 0.5))
    x = np.stack([np.full(len(known), rate), np.log((ones + 0.4 + 8 / (1 + np.exp(-rate))) / (seen - ones + 0.4 + 8 / (1 + np.exp(rate))))])
    listed = online_mix(x, np.zeros(len(known), np.int64), 1, known.astype(float), tokens.text, texts, np.array([0.5, 0.5]))
    listed = np.clip(listed, 1e-9, 1 - 1e-9)
    # A listed word's probability cannot vanish, so only the others need logarithms all the way
    total = np.log1p(-listed) + spelled[tokens.word]
    chance = listed * dictionary_chances(tokens, count, shares, kind_tokens, first) + (1 - listed) * np.exp(spelled)[tokens.word]
    total[known] = np.log(chance[known])
    if found is not None:
        total = follow_costs(tokens, texts, found, total, first)
    at = np.flatnonzero(tokens.tried)
    if len(at):
        s = tokens.slots[:, at]
        x = np.concatenate([np.log((hits[1, s] + 0.4) / (hits[0, s] + 0.8)), tokens.rate[None, at], np.full((1, len(at)), 0.3)])
        p = np.clip(online_mix(x, tokens.run[at], 3, tokens.hit[at].astype(float), tokens.text[at], texts, np.array([0.3, 0.3, 0.3, 0.2, 0.0])), 1e-9, 1 - 1e-9)
        total[at] = np.where(tokens.hit[at], np.log(p + (1 - p) * np.exp(total[at])), np.log1p(-p) + total[at])
    return np.bincount(tokens.text, total, texts)


# ---- the corpus -----------------------------------------------------------------------------------------------------

_DOC, _WORD, _HIT, _PAIR = 0, 1, 2, 3


def _packed(numbers: np.ndarray) -> bytes:
    """Word numbers of a text, by planes of equal bytes, compressed, behind their count."""
    return len(numbers).to_bytes(8, "little") + pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    planes = pa.decompress(raw[8:], 4 * int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1)


_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


@dataclass
class Words:
    """The words of some texts: their bytes between spaces, which of these are spaces, where each word begins and ends, and
    how many words each text has."""
    buf: np.ndarray
    space: np.ndarray
    start: np.ndarray
    end: np.ndarray
    many: np.ndarray

    @staticmethod
    def of(texts: list[bytes]) -> Words:
        buf = np.frombuffer(b" " + b" ".join(texts) + bytes([32] * 9), np.uint8)
        size = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        space = _IS_SPACE[buf]
        start, end = (np.flatnonzero(space[1:] != space[:-1]) + 1).reshape(-1, 2).T
        return Words(buf, space, start, end, np.diff(np.searchsorted(start, np.cumsum(size) + 1), prepend=0))

    def tokens(self) -> tuple[pa.DictionaryArray, np.ndarray]:
        """All words, an empty one behind those of each text, and where the texts end."""
        end = np.cumsum(self.many + 1)
        size = np.zeros(len(self.start) + len(end), np.int64)
        size[np.delete(np.arange(len(size)), end - 1)] = self.end - self.start
        offsets = np.concatenate(([0], np.cumsum(size)))
        words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(self.buf[~self.space])])
        return words.dictionary_encode(), end


def _listed(words: pa.LargeBinaryArray) -> list[bytes]:
    """As ``to_pylist``, without an object of Arrow's for each."""
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1].tolist()
    raw = words.buffers()[2].to_pybytes()
    return [raw[i:j] for i, j in zip(at, at[1:])]


def text_profiles(texts: list[bytes] | Words) -> np.ndarray:
    """One row of bytes per text: square roots of the counts of its hashed words, in 255ths of the largest. Words go by
    their first eight bytes and their length; a text without words has zeros."""
    found = texts if isinstance(texts, Words) else Words.of(texts)
    buf, start, end, texts = found.buf, found.start, found.end, found.many
    head = np.lib.stride_tricks.sliding_window_view(buf, 8)[start].view("<u8")[:, 0]
    head &= ~np.uint64(0) >> (8 * (8 - np.minimum(end - start, 8))).astype(np.uint64)
    h = (head + (end - start).astype(np.uint64)) * _C1
    slot = (((h ^ (h >> np.uint64(29))) * _C2) >> np.uint64(40)).astype(np.int64) % PROFILE
    text = np.repeat(np.arange(len(texts)), texts)
    x = np.sqrt(np.bincount(text * PROFILE + slot, minlength=len(texts) * PROFILE).reshape(-1, PROFILE).astype(np.float32))
    return np.rint(x * (255 / np.maximum(x.max(1, keepdims=True), 1))).astype(np.uint8)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), np.float32(1e-9))


def _nearest(profiles: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(_unit(profiles) @ centres.T, axis=1)


def text_kinds(sums: np.ndarray, kinds: int, rounds: int = 20, tries: int = 8) -> np.ndarray:
    """Centres of at most ``kinds`` clusters of vectors that weigh as much as they are long: k-means by cosine, the best of ``tries`` runs."""
    size = np.linalg.norm(sums, axis=1)
    sums, size = sums[size > 0], size[size > 0]
    unit, r = _unit(sums), np.random.RandomState(0)
    if len(sums) <= kinds:
        return unit
    best, found = -1.0, unit[:0]
    for _ in range(tries):
        seeds: list[int] = []
        far = np.ones(len(unit))
        while len(seeds) < kinds and (weight := np.cumsum(size * far))[-1] > 1e-4 * size.sum():
            seeds.append(int(np.searchsorted(weight[:-1], r.rand() * weight[-1], "right")))
            far = np.minimum(far, np.maximum(1 - unit @ unit[seeds[-1]], 0))
        centres = unit[seeds]
        for _ in range(rounds):
            near = unit @ centres.T
            of = np.argmax(near, axis=1)
            moved = (of == np.arange(len(centres))[:, None]).astype(float) @ sums
            centres = np.where(moved.any(1, keepdims=True), _unit(moved), centres)
        if (quality := float(size @ near.max(1))) > best:
            best, found = quality, centres
    return found


def _candidates(profiles: DataFrame, chosen: np.ndarray, salt: int) -> np.ndarray:
    """CANDIDATES different profiles, drawn from all by their distance from those chosen, whatever task they are in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[float, bytes]] = []
        for batch in batches:
            raw = batch.column(0).to_pylist()
            x = _unit(np.frombuffer(b"".join(raw), np.uint8).reshape(-1, PROFILE))
            far = np.maximum(1 - (x @ chosen.T).max(1), 0) if len(chosen) else np.ones(len(x))
            draw = -np.log((np.fromiter((zlib.crc32(v, salt) for v in raw), float, len(raw)) + 0.5) / 2 ** 32)
            with np.errstate(divide="ignore"):
                draw = np.where(x.any(1), draw / far, np.inf)
            first = np.flatnonzero(draw < (best[-1][0] if len(best) == CANDIDATES else np.inf))
            best = sorted({*best, *((float(draw[i]), raw[i]) for i in first)})[:CANDIDATES]
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in best], pa.float64()), pa.array([v for _, v in best], pa.binary())], ["draw", "x"])

    rows = profiles.mapInArrow(run, "draw double, x binary").dropDuplicates(["x"]).orderBy("draw", "x").limit(CANDIDATES).collect()
    return _unit(np.frombuffer(b"".join(r.x for r in rows), np.uint8).reshape(-1, PROFILE))


def _sums(profiles: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The sum of the profiles nearest to each centre, in whole numbers, so that the order of rows makes no difference."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(centres), PROFILE))
        for batch in batches:
            x = _unit(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, PROFILE))
            of = np.argmax(x @ centres.T, axis=1)
            sums += (of == np.arange(len(centres))[:, None]).astype(float) @ np.rint(x.astype(float) * 65_536)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums.reshape(-1)[at].astype(np.int64))], ["at", "v"])

    table = profiles.mapInArrow(run, "at int, v long").groupBy("at").agg(F.sum("v").alias("v")).toArrow()  # of fixed size
    out = np.zeros(len(centres) * PROFILE)
    out[table["at"].to_numpy()] = table["v"].to_numpy()
    return out.reshape(-1, PROFILE)


def _found_kinds(frame: DataFrame, kinds: int) -> np.ndarray:
    """Centres of the kinds from the profiles of all training texts, by parallel k-means: candidates drawn from all
    texts, the sums of the texts nearest to each clustered here, then passes that move the centres to the means."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_TEXTS):
                texts = [(t or b"").lower() for t in batch.column(0).slice(at, SLICE_TEXTS).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in text_profiles(texts)], pa.binary())], ["x"])

    profiles = keep(frame.where("not held").select("text").mapInArrow(run, "x binary"), "profiles")
    chosen = np.zeros((0, PROFILE), np.float32)
    for salt in range(SEED_PASSES):
        chosen = np.concatenate([chosen, _candidates(profiles, chosen, salt)])
    if not len(chosen):
        return np.zeros((1, PROFILE), np.float32)
    centres = text_kinds(_sums(profiles, chosen), kinds)
    for _ in range(MOVES):
        sums = _sums(profiles, centres)
        centres = np.where(sums.any(1, keepdims=True), _unit(sums), centres)
    return centres


def _sorted_packed(numbers: np.ndarray) -> bytes:
    return _packed(np.diff(numbers, prepend=numbers.dtype.type(0)))


def _sorted_unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw), dtype=np.int64)


def _others(rows: pd.DataFrame) -> pd.DataFrame:
    """For one part of the pairs: how often the other blocks' training texts have each pair of a block, in the block's order."""
    keys, times = [_sorted_unpacked(x) for x in rows["keys"]], [_unpacked(x) for x in rows["times"]]
    end = np.cumsum([len(x) for x in keys])
    key, time = np.concatenate(keys).astype(np.uint32), np.concatenate(times).astype(np.int64)
    del keys, times
    order = np.argsort(key, kind="stable")
    key = key[order]
    group = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1
    all_times = np.bincount(group, time[order]).astype(np.int64)
    rest = np.empty(len(key), np.int64)
    rest[order] = all_times[group]
    rest -= time
    return pd.DataFrame({"block": rows["block"], "part": rows["part"], "found": [_packed(np.minimum(x, (1 << 32) - 1)) for x in np.split(rest, end[:-1])]})


def _blocks(frame: DataFrame, kind: str, block_bytes: int, centres: np.ndarray, bits: int = 0) -> DataFrame:
    """Rows of four kinds: texts as word numbers of their block, the block's words with their training counts, the block's
    training counts of hits, and its pairs of neighbours by parts with their training counts."""
    own = [f"c{k}" for k in range(len(centres))]    # training counts by kind of text
    schema = (f"kind int, block long, id {kind}, held boolean, tokens binary, n_bytes long, number int, word binary, n long, m long, " + ", ".join(f"{c} long" for c in own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type, part, blocks = None, 0, 0
        rows, coded, size = [], [], 0       # of the texts: ids, held or not, bytes, kinds; their words, and where they end

        def batch_of(kind_, count, **columns):
            types = {"kind": pa.int32(), "block": pa.int64(), "id": id_type, "held": pa.bool_(), "tokens": pa.binary(),
                     "n_bytes": pa.int64(), "number": pa.int32(), "word": pa.binary(), "n": pa.int64(), "m": pa.int64(),
                     **{c: pa.int64() for c in own}}
            columns = {"kind": np.full(count, kind_), "block": np.full(count, (part << 24) + blocks), **columns}
            return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(count, t)
                                               for c, t in types.items()], list(types))

        def close():
            ids, held, n_bytes, kinds = (list(chain.from_iterable(x)) for x in zip(*rows))
            chunks = pa.chunked_array([x for x, _ in coded]).unify_dictionaries().chunks
            words = _listed(chunks[0].dictionary)
            texts = [t for x, (_, end) in zip(chunks, coded) for t in np.split(x.indices.to_numpy(), end[:-1])]
            crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
            mark = (crc >> 4).astype(np.int64)
            of_kind: list[list[np.ndarray]] = [[np.zeros(0, np.int32)] for _ in own]
            for h, t, of in zip(held, texts, kinds):
                if not h:
                    of_kind[of].append(t)
            trained = [np.bincount(np.concatenate(ts), minlength=len(words)) for ts in of_kind]
            yield batch_of(_DOC, len(ids), id=ids, held=held, tokens=[_packed(t) for t in texts], n_bytes=n_bytes)
            yield batch_of(_WORD, len(words), number=np.arange(len(words)), word=words, **dict(zip(own, trained)))
            found = np.zeros((2, HIT_SLOTS), np.int64)
            for part_of in _slices(t for t, h in zip(texts, held) if not h):
                seen = look_back(part_of, mark)
                at = np.flatnonzero(seen.tried)
                for v in (0, 1):
                    found[v] += np.bincount(seen.slots[:, at[seen.hit[at] == v]].reshape(-1), minlength=HIT_SLOTS)
            slot = np.flatnonzero(found[0] + found[1])
            yield batch_of(_HIT, len(slot), number=slot, n=found[0][slot], m=found[1][slot])
            pairs, times = block_pairs(texts, held, crc, bits)
            part = (pairs >> np.uint64(PAIR_BITS)).astype(np.int64)
            start = np.flatnonzero(np.diff(part, prepend=-1))
            yield batch_of(_PAIR, len(start), number=part[start], word=[_sorted_packed(x.astype(np.uint32)) for x in np.split(pairs, start[1:])],
                           tokens=[_packed(x) for x in np.split(times, start[1:])])

        for batch in batches:
            id_type = batch.column("id").type
            for at in range(0, batch.num_rows, SLICE_TEXTS):
                part = batch.column("part")[at].as_py()
                raws = [(t or b"").lower() for t in batch.column("text").slice(at, SLICE_TEXTS).to_pylist()]
                ids, held = (batch.column(c).slice(at, SLICE_TEXTS).to_pylist() for c in ("id", "held"))
                done = 0
                while done < len(raws):
                    # Up to the text that fills the block
                    now = done
                    while now < len(raws) and size < block_bytes:
                        size += len(raws[now]) + 64
                        now += 1
                    found = Words.of(raws[done:now])
                    rows.append((ids[done:now], held[done:now], [len(t) for t in raws[done:now]],
                                 _nearest(text_profiles(found), centres).tolist()))
                    coded.append(found.tokens())
                    done = now
                    if size >= block_bytes:
                        yield from close()
                        rows, coded, size, blocks = [], [], 0, blocks + 1
        if rows:
            yield from close()

    return frame.mapInArrow(run, schema)


def _trained_spelling(vocabulary: DataFrame) -> Spelling:
    """Counts, weights and map from all training words (column ``word``; every word counts once)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(ORDERS), 1 << SLOT_BITS, 2), np.int32)
        for batch in batches:
            spelling_counts(batch.column(0).to_pylist(), counts)
        flat = counts.reshape(-1, 2).T
        slot = np.flatnonzero(flat[0] + flat[1])
        for i in range(0, len(slot), 1 << 16):
            s = slot[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(flat[0][s]), pa.array(flat[1][s])], ["slot", "n", "m"])

    spark = vocabulary.sparkSession
    # As many rows as there are slots at most, whatever the corpus
    table = (vocabulary.mapInArrow(count, "slot int, n int, m int").groupBy("slot")
             .agg(F.sum("n").cast("float").alias("n"), F.sum("m").cast("float").alias("m")).toArrow())
    counts = np.zeros((len(ORDERS) << SLOT_BITS, 2), np.float32)
    slot = table["slot"].to_numpy()
    counts[slot, 0], counts[slot, 1] = table["n"].to_numpy(), table["m"].to_numpy()
    counts = counts.reshape(len(ORDERS), 1 << SLOT_BITS, 2)
    shared = spark.sparkContext.broadcast(counts)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bits = Spelling.fresh(shared.value), 0
        tables = model.learning_tables()
        for batch in batches:
            bits += model.learn(batch.column(0).to_pylist(), tables=tables)
        w, cells = model.weights.reshape(-1) * bits, model.cells.reshape(-1)
        at = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((np.arange(len(w)), len(w) + at, [-1])).astype(np.int32)),
                                          pa.array(np.concatenate((w, cells[at], [bits])).astype(float))], ["at", "v"])

    # Weights averaged over the tasks, by the bits each has seen
    learned = vocabulary.mapInArrow(learn, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    model = Spelling.fresh(counts)
    at, v = learned["at"].to_numpy(), learned["v"].to_numpy()
    bits = v[at == -1].sum()
    if bits:
        flat = model.weights.reshape(-1)
        mine = (at >= 0) & (at < len(flat))
        flat[at[mine]] = v[mine] / bits
        rest = at >= len(flat)
        model.cells.reshape(-1)[at[rest] - len(flat)] = v[rest]
    shared.unpersist()
    return model


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
          text_kinds_most: int = KINDS) -> DataFrame:
    """Learns from the rows where ``held_out`` is false and scores all rows.

    One row per document: id, held_out, n_tokens, n_known (tokens that training has), train_tokens, base_score (log10
    probability under add-one word counts), score (log10 probability under the model), n_bytes (of the text),
    bits_per_byte (of the score; null for an empty text).
    A null text is an empty one: its one token is the end. A null ``held_out`` counts as false. Repeated rows count and
    are scored each, a null id stays null, other columns are ignored, an empty table gives an empty result. If nothing
    is left to learn from, all words are spelled out by an untrained model.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    frame = docs.select(docs[id_col].alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                        docs[text_col].cast("binary").alias("text"), F.spark_partition_id().alias("part"))
    centres = _found_kinds(frame, text_kinds_most)
    text_bytes = frame.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pair_bits = min(PART_BITS, max(0, int(np.ceil(np.log2(max(text_bytes, 1) / PAIR_BYTES)))))
    blocks = keep(_blocks(frame, kind, block_bytes, centres, pair_bits), "blocks")
    own = [f"c{k}" for k in range(len(centres))]
    words = blocks.where(F.col("kind") == _WORD).select(F.col("block").alias("of"), "number", "word", *own)
    counted = keep(words.groupBy("word").agg(*[F.sum(c).alias(c) for c in own]), "vocabulary")
    c = sum((F.col(x) for x in own), F.lit(0))
    *per_kind, kinds, single = (int(x) for x in counted.agg(*[F.coalesce(F.sum(x), F.lit(0)) for x in own], F.count_if(c > 0),
                                                            F.count_if(c == 1)).first())
    kind_tokens, n = np.array(per_kind, float), sum(per_kind)
    # Few tasks with many words each: a task gives up to as many rows as there are slots
    trained = counted.where(c > 0).select("word").coalesce(max(2, kinds // TASK_WORDS))
    spelling = _trained_spelling(trained)
    spark = docs.sparkSession
    hit_rows = (blocks.where(F.col("kind") == _HIT).groupBy("number").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).toArrow())
    hits = np.zeros((2, HIT_SLOTS))
    hits[0, hit_rows["number"].to_numpy()], hits[1, hit_rows["number"].to_numpy()] = hit_rows["n"].to_numpy(), hit_rows["m"].to_numpy()
    shared = spark.sparkContext.broadcast((spelling.counts, spelling.weights, spelling.cells))  # of fixed size

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Spelling(*shared.value)
        tables = model.tables()
        for batch in batches:
            words_in = batch.column("word").to_pylist()
            rows = np.zeros(len(words_in), entry)
            by_kind = np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in own], 1)
            rows["crc"] = np.fromiter(map(zlib.crc32, words_in), np.uint32, len(words_in))
            rows["spelled"] = model.cost(words_in, tables) * (1 + 2 ** -22)  # rounded away from zero
            rows["count"] = by_kind.sum(1)
            rows["shares"] = by_kind * 255 // np.maximum(by_kind.sum(1, keepdims=True), 1)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array([x.tobytes() for x in rows], pa.binary())], ["word", "entry"])

    # What a block must know of a word, in few bytes, since most words stand in one block or two: its hash, the cost of its
    # letters, its count, and what part of that belongs to each kind of text (parts are rounded down, so that no
    # probability comes out too large)
    entry = np.dtype([("crc", "<u4"), ("spelled", "<f4"), ("count", "<f4"), ("shares", "u1", (len(own),))])
    vocabulary = keep(counted.mapInArrow(spell, "word binary, entry binary"), "spelled")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Many words of a block in one row, by planes of equal bytes, compressed."""
        some: list[pa.RecordBatch] = []

        def packed() -> pa.RecordBatch:
            of, number = (np.concatenate([b.column(c).to_numpy() for b in some]) for c in (0, 1))
            rows = np.frombuffer(b"".join(chain.from_iterable(b.column(2).to_pylist() for b in some)), np.uint8).reshape(len(of), -1)
            order = np.lexsort((number, of))
            start = np.flatnonzero(np.diff(of[order], prepend=-1))
            cut = np.split(order, start[1:])
            return pa.RecordBatch.from_arrays([pa.array(of[order[start]]), pa.array([_sorted_packed(number[x]) for x in cut], pa.binary()),
                                               pa.array([pa.compress(rows[x].T.tobytes(), "zstd", asbytes=True) for x in cut], pa.binary())], ["of", "numbers", "entries"])

        for batch in batches:
            if batch.num_rows:
                some.append(batch)
            if sum(b.num_rows for b in some) >= PACK_ROWS:
                yield packed()
                some = []
        if some:
            yield packed()

    dictionary = (words.drop(*own).join(vocabulary, "word").select("of", "number", "entry")
                  .mapInArrow(pack, "of long, numbers binary, entries binary"))
    # Counts of pairs come beside the texts, under negative numbers of bytes
    elsewhere = (blocks.where(F.col("kind") == _PAIR).select("block", F.col("number").alias("part"), F.col("word").alias("keys"), F.col("tokens").alias("times"))
                 .groupBy("part").applyInPandas(_others, "block long, part int, found binary"))
    texts = (blocks.where(F.col("kind") == _DOC).select("block", "id", "held", "tokens", "n_bytes")
             .unionByName(elsewhere.select("block", F.col("found").alias("tokens"), (-1 - F.col("part")).cast("long").alias("n_bytes")), allowMissingColumns=True))

    def block_scores(docs_in: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        numbers = [_sorted_unpacked(x) for x in listed["numbers"]]
        rows = np.empty(sum(map(len, numbers)), entry)
        for at, raw in zip(numbers, listed["entries"]):
            planes = pa.decompress(raw, len(at) * entry.itemsize, "zstd", asbytes=True)
            rows[at] = np.frombuffer(planes, np.uint8).reshape(entry.itemsize, -1).T.copy().view(entry)[:, 0]
        answers = docs_in[docs_in["n_bytes"] < 0].sort_values("n_bytes", ascending=False)["tokens"]
        docs_in = docs_in[docs_in["n_bytes"] >= 0].sort_values("n_bytes", ascending=False)   # texts of like length advance together
        held_in = docs_in["held"].to_numpy(bool)
        pairs, times = block_pairs(map(_unpacked, docs_in["tokens"]), held_in, rows["crc"], pair_bits)
        times = times.astype(np.float64)
        times += np.concatenate([_unpacked(x) for x in answers])
        parts, done = [], 0
        for texts_in in _slices(map(_unpacked, docs_in["tokens"])):
            texts_in, own_words = _renumbered(texts_in, len(rows))
            of, many = rows[own_words], len(texts_in)
            count, crc = of["count"].astype(float), of["crc"]
            tokens, base = look_back(texts_in, (crc >> 4).astype(np.int64)), np.log10((count + 1) / (n + kinds + 1))
            found = Followers.of(texts_in, tokens, held_in[done:done + many], count, crc, pair_bits, pairs, times)
            done += many
            parts.append(np.stack([
                np.bincount(tokens.text, minlength=many), np.bincount(tokens.text, count[tokens.word] > 0, many),
                np.bincount(tokens.text, base[tokens.word], many),
                text_costs(tokens, many, count, of["shares"], of["spelled"].astype(float), kind_tokens, single, hits, found)]))
        tokens_in, known, base_in, found = np.concatenate(parts, axis=1)
        found, size = found / np.log(10), docs_in["n_bytes"].to_numpy()
        return pd.DataFrame({
            "id": docs_in["id"], "held_out": docs_in["held"], "n_tokens": tokens_in.astype(np.int64), "n_known": known.astype(np.int64),
            "train_tokens": n, "base_score": base_in, "score": found, "n_bytes": size,
            "bits_per_byte": np.where(size > 0, -found * np.log2(10) / np.maximum(size, 1), np.nan)})

    out = (texts.groupBy("block").cogroup(dictionary.groupBy("of"))
           .applyInPandas(block_scores, f"id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                        "base_score double, score double, n_bytes long, bits_per_byte double"))
    return out.withColumn("bits_per_byte", F.nanvl("bits_per_byte", F.lit(None))).withColumnRenamed("id", id_col)
