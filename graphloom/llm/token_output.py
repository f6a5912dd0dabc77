"""Token ids as Re-Pair grammars: shards that hold rules, expansion lengths and short symbol sequences.

Documents are dealt to tasks by ascending doc_id, and each task cuts its own into shards with a grammar each: the most frequent pairs of
neighbouring symbols become nonterminals, until none is frequent, within documents only. A document can be decoded alone: its symbols
are a slice of the shard's sequence, and stored expansion lengths place any token of it without expanding what stands before.

Shard layout (little-endian): magic ``RPB2``; six uint32: first nonterminal, rules, documents, symbols, bits per symbol, 0; then
rules (two uint32 each), expansion lengths (uint32 per rule), symbols per document (uint32), tokens per document (uint32), the lower 16
bits of the symbols (uint16), and a bit plane for each higher bit of them, the lowest plane first, each filled up to whole bytes.
Task, shard number and first and last doc_id are columns beside it, so that a reader skips shards by the files' statistics.
"""

from __future__ import annotations

import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import Words, mix, releasing, span_hashes, text_slices

MAGIC = b"RPB2"


#: The UTF-8 forms of blanks beyond ASCII, which tokenizers may join to the blanks around them.
_WIDE_BLANKS = np.array([int.from_bytes(c.encode().ljust(3, b"\0"), "big") for c in "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"])
_WIDE_LEADS = np.zeros(256, bool)
_WIDE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: By the byte before a word; 0 where it opens its text.
_SEPARATORS = {0: b"", 10: b"\n", 32: b" "}


def _wide_blanks(data: np.ndarray) -> np.ndarray:
    """Where blanks beyond ASCII begin."""
    at = np.flatnonzero(_WIDE_LEADS[data])
    code = np.zeros(len(at), np.int64)
    for k in range(3):
        code = code << 8 | data[np.minimum(at + k, len(data) - 1)]
    two = data[at] == 0xC2
    return at[np.isin(np.where(two, code & 0xFFFF00, code), _WIDE_BLANKS)]


#: Bytes of letters: ASCII ones, and U+00C0 to U+024F in two bytes; without 97 and B7, which also end the signs of multiplication and division.
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0), *range(0xC3, 0xCA)]] = True
_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
#: ASCII punctuation without the apostrophe, which may open a piece of its own.
_MARKS = np.zeros(256, bool)
_MARKS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = True
#: Marks at a word's end that are looked at.
_TAIL = 8
#: The first k of eight bytes, k from 0 to 8.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bits of a hash that choose a unit's slot.
_SLOT_BITS = 20


class UnitEncoder:
    """Encodes texts through a tokenizer, unit by unit: a word with the single blank or line end before it, or the marks that end a word.

    A byte-level tokenizer cuts a text into pieces before it merges. A single space between two other characters always begins a piece,
    a single line end is one, and so are marks between a letter or digit and a blank; so the ids of a text without added tokens are those of
    its units, and each distinct unit is encoded once. Units of letters alone go straight to the tokenizer's model, as one piece each. Texts with
    other blanks or several in a row are encoded whole. Units are found by hash, most of them in one of 2^20 slots, the rest among the sorted
    hashes, and compared: by separator, size and their first and last eight bytes, longer ones byte by byte. A text with a unit that
    only shares another's hash is encoded whole too, and so is one that holds an added token of the tokenizer, which the library takes out
    before it cuts. Beyond ``max_units`` those are forgotten that were not met again since they were
    learned, or all if these are few. With a tokenizer of another kind all texts are encoded whole.
    """

    def __init__(self, path: str, max_units: int = 1_000_000):
        # a task has one core; threads of the library's own would each keep memory and spin
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.max_units = max_units
        plan = json.loads(self.tokenizer.to_str())
        model, cut = {k: v for k, v in plan["model"].items() if v is not None}, plan["pre_tokenizer"] or {}
        kind = model.pop("type")
        self.by_unit = kind == "BPE" and plan["normalizer"] is None and cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]
        added = [t for t in plan["added_tokens"] if t["content"]]
        self.added = [t["content"].encode() for t in added]
        self.by_unit &= not any(t["normalized"] and plan["normalizer"] for t in added)
        if self.by_unit:  # as each unit comes once, the library's own cache of words would only be searched in vain
            self.tokenizer.model = models.BPE(**model | {"merges": [tuple(m) for m in model["merges"]]}, cache_capacity=0)
            self.pieces = Tokenizer(self.tokenizer.model)
            self.pieces.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
            signs = [self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(128)]  # a byte's sign in the vocabulary
            latin = {c: self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x250)}
            self.signs = dict(enumerate(signs)) | {b: s for c, two in latin.items() for b, s in zip(chr(c).encode(), two, strict=True)}
            del self.signs[10]
            vocabulary = self.tokenizer.get_vocab()
            self.opens = {c: np.zeros(max(vocabulary.values()) + 1, bool) for c in (32, 10)}
            for token, k in vocabulary.items():
                for c in (32, 10):
                    self.opens[c][k] = token.startswith(signs[c])
        self.forget()

    def forget(self) -> None:
        # unit 0 is none: no word has its size
        self.keys, self.number = np.zeros(1, np.uint64), np.zeros(1, np.int32)  # sorted hashes, and the units they stand for
        self.slots = np.zeros(1 << _SLOT_BITS, np.int32)
        self.heads, self.lasts, self.codes = np.zeros(1, np.uint64), np.zeros(1, np.uint64), np.zeros(1, np.int64)
        self.units, self.unit_at = np.zeros(0, np.uint8), np.zeros(2, np.int64)  # bytes of the long ones
        self.ids, self.ids_at = np.zeros(0, np.uint32), np.zeros(2, np.int64)
        self.met = np.zeros(1, bool)  # again, after the slice that they were learned from

    def _forget_rare(self) -> None:
        stay = self.met.copy()
        stay[0] = True
        if 2 * np.count_nonzero(stay) > self.max_units:
            self.forget()
            return
        number = np.cumsum(stay, dtype=np.int32) - np.int32(1)
        self.slots = np.where(stay[self.slots], number[self.slots], np.int32(0))
        known = stay[self.number]
        self.keys, self.number = self.keys[known], number[self.number[known]]
        self.heads, self.lasts, self.codes = self.heads[stay], self.lasts[stay], self.codes[stay]
        n, m = np.diff(self.unit_at), np.diff(self.ids_at)
        self.units, self.ids = self.units[np.repeat(stay, n)], self.ids[np.repeat(stay, m)]
        self.unit_at, self.ids_at = np.cumsum(np.append(0, n[stay])), np.cumsum(np.append(0, m[stay]))
        self.met = np.zeros(len(self.codes), bool)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _spaced_letters(self, words: list[bytes]) -> list[np.ndarray]:
        runs = [words[k : k + 1000] for k in range(0, len(words), 1000)]
        texts = [(b" " + b"\n ".join(r)).decode("latin-1").translate(self.signs) for r in runs]
        return [np.array(e.ids, np.uint32) for e in self.pieces.encode_batch_fast(texts, add_special_tokens=False)]

    def _unit_ids(self, separator: int, letters: bool, words: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of units with one separator, and how many each has: many in one text, which falls apart where a token opens with the separator."""
        step = 1000 if separator else 1
        runs = [words[k : k + step] for k in range(0, len(words), step)]
        sign, sizes = _SEPARATORS[separator], []
        found = self._spaced_letters(words) if letters and separator == 32 else self._whole([(sign + sign.join(r)).decode() for r in runs])
        for k, (run, ids) in enumerate(zip(runs, found, strict=True)):
            at = np.flatnonzero(self.opens[separator][ids]) if separator else np.zeros(1, np.int64)
            if len(at) != len(run) or (len(ids) and at[0]):  # never seen; one by one it is right in any case
                own = self._whole([(sign + w).decode() for w in run])
                found[k] = np.concatenate(own)
                sizes.append(np.array([len(x) for x in own]))
            else:
                sizes.append(np.diff(np.append(at, len(ids))))
        return found, sizes

    def _learn(self, keys: np.ndarray, forms: tuple[np.ndarray, ...], data: np.ndarray, starts: np.ndarray) -> None:
        separators, lens = forms[2] % 64, forms[2] // 64
        first = np.cumsum(lens) - lens
        letters = np.logical_and.reduceat(_LETTERS[data[np.repeat(starts - first, lens) + np.arange(int(lens.sum()))]], first)
        kind = separators * 2 + letters
        order = np.argsort(kind, kind="stable")
        keys, kind, starts, lens = keys[order], kind[order], starts[order], lens[order]
        raw = data.tobytes()
        words = [raw[a:b] for a, b in zip(starts.tolist(), (starts + lens).tolist(), strict=True)]
        ids, sizes = [], []
        edge = np.flatnonzero(np.diff(kind, prepend=-1, append=-1))
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            own = self._unit_ids(int(kind[i]) // 2, bool(kind[i] % 2), words[i:j])
            ids += own[0]
            sizes += own[1]
        n_known = len(self.number)
        slot = keys >> np.uint64(64 - _SLOT_BITS)
        empty = np.flatnonzero(self.slots[slot] == 0)
        self.slots[slot[empty]] = empty + n_known
        sorted_ = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[sorted_])
        self.keys, self.number = np.insert(self.keys, at, keys[sorted_]), np.insert(self.number, at, sorted_ + n_known)
        self.heads, self.lasts, self.codes = (np.concatenate([x, f[order]]) for x, f in zip((self.heads, self.lasts, self.codes), forms, strict=True))
        self.met = np.append(self.met, np.zeros(len(keys), bool))
        self.units = np.concatenate([self.units, np.frombuffer(b"".join(w for w in words if len(w) > 16), np.uint8)])
        self.unit_at = np.concatenate([self.unit_at, self.unit_at[-1] + np.cumsum(np.where(lens > 16, lens, 0))])
        self.ids = np.concatenate([self.ids, *ids])
        self.ids_at = np.concatenate([self.ids_at, self.ids_at[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of each text's. Text k is the UTF-8 bytes from ``offsets[k]`` to ``offsets[k + 1]``."""
        if len(self.keys) > self.max_units:
            self._forget_rare()
        n_texts = len(offsets) - 1
        single, n, ids = np.zeros(n_texts, bool), np.zeros(n_texts, np.int64), np.zeros(0, np.uint32)
        if self.by_unit:
            single, n, ids = self._by_unit(data, offsets)
        whole = np.flatnonzero(~single & (np.diff(offsets) > 0)).tolist()
        if whole:
            found = self._whole([data[offsets[k] : offsets[k + 1]].tobytes().decode() for k in whole])
            begin = np.cumsum(n) - n
            ids = np.insert(ids, np.repeat(begin[whole], [len(x) for x in found]), np.concatenate(found))
            n[whole] = [len(x) for x in found]
        return ids, n

    def _by_unit(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which texts are encoded by units, the number of each text's ids, and the ids."""
        words = Words(data, offsets, hashed=False)
        n_texts, n_words = len(offsets) - 1, np.diff(words.bounds)
        text = np.repeat(np.arange(n_texts), n_words)
        before = np.zeros(len(text), np.uint8)
        inner = np.ones(len(text), bool)
        inner[words.bounds[:-1][n_words > 0]] = False
        before[inner] = data[words.starts[inner] - 1]
        odd = inner & (before != 32) & (before != 10)
        odd[1:] |= inner[1:] & (words.starts[1:] - words.ends[:-1] != 1)
        single = n_words > 0
        single[single] = (words.starts[words.bounds[:-1][single]] == offsets[:-1][single]) & (words.ends[words.bounds[1:][single] - 1] == offsets[1:][single])
        single[text[odd]] = False
        raw = data.tobytes()
        for token in self.added:
            at = raw.find(token)
            while at >= 0:  # over two texts at the worst: then one is encoded whole that need not be
                single[np.searchsorted(offsets, at, side="right") - 1] = False
                at = raw.find(token, at + 1)
        wide = _wide_blanks(data)
        single[np.searchsorted(offsets, wide, side="right") - 1] = False

        own = np.flatnonzero(single[text])
        if not len(own):
            return single, np.zeros(n_texts, np.int64), np.zeros(0, np.uint32)
        text, start, end, before = text[own], words.starts[own], words.ends[own], before[own]
        tail = np.zeros(len(own), np.int64)
        open_ = np.flatnonzero(_MARKS[data[end - 1]])
        while len(open_) and int(tail[open_[0]]) < _TAIL:
            tail[open_] += 1
            open_ = open_[end[open_] - tail[open_] > start[open_]]
            open_ = open_[_MARKS[data[end[open_] - 1 - tail[open_]]]]
        at = np.flatnonzero(tail)
        last = data[np.maximum(end[at] - 1 - tail[at], start[at])]
        lead = data[np.maximum(end[at] - 2 - tail[at], start[at])]
        two = (last >= 0x80) & (last < 0xC0) & _LETTERS[last] & (lead >= 0xC3) & (lead < 0xCA)
        cut = (end[at] - tail[at] > start[at]) & (_ASCII_WORD[last] | two)
        at, tail = at[cut], tail[at[cut]]
        more = at + 1  # the marks of a word stand after it
        start, end = np.insert(start, more, end[at] - tail), np.insert(end, more, end[at])
        text, before = np.insert(text, more, text[at]), np.insert(before, more, 0)
        end[at + np.arange(len(at))] -= tail
        size = end - start

        # the eight bytes from each place on
        eights = np.ascontiguousarray(np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,)))
        forms = eights[start] & _FIRST[np.minimum(size, 8)], np.where(size > 8, eights[np.maximum(end - 8, 0)], np.uint64(0)), size * 64 + before
        del eights
        long = np.flatnonzero(size > 16)
        with np.errstate(over="ignore"):
            key = forms[0] * np.uint64(0xA24BAED4963EE407) + forms[1] * np.uint64(0x9FB21C651E98DF25) + forms[2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            key[long] += span_hashes(data, start[long] + 8, size[long] - 16)
        key = mix(key)
        unit = self.slots[key >> np.uint64(64 - _SLOT_BITS)]
        same = (self.heads[unit] == forms[0]) & (self.lasts[unit] == forms[1]) & (self.codes[unit] == forms[2])
        self.met[unit[same]] = True
        rest = np.flatnonzero(~same)
        if len(rest):
            own, first, which = np.unique(key[rest], return_index=True, return_inverse=True)
            place = np.searchsorted(self.keys, own)
            new = self.keys[np.minimum(place, len(self.keys) - 1)] != own
            self.met[self.number[place[~new]]] = True
            new = np.flatnonzero(new)
            if len(new):
                of = rest[first[new]]
                self._learn(own[new], tuple(f[of] for f in forms), data, start[of])
                place = np.searchsorted(self.keys, own)
            unit[rest] = found = self.number[place][which]
            same[rest] = (self.heads[found] == forms[0][rest]) & (self.lasts[found] == forms[1][rest]) & (self.codes[found] == forms[2][rest])
        long = long[same[long]]
        if len(long):
            n = size[long]
            lead = np.cumsum(n) - n
            run = np.arange(int(n.sum()))
            alike = data[np.repeat(start[long] - lead, n) + run] == self.units[np.repeat(self.unit_at[unit[long]] - lead, n) + run]
            same[long] = np.logical_and.reduceat(alike, lead)
        if not same.all():
            single[text[~same]] = False
            unit, text = unit[single[text]], text[single[text]]
        begin = self.ids_at[unit]
        sizes = self.ids_at[unit + 1] - begin
        ends = np.cumsum(sizes)
        ids = self.ids[np.arange(int(sizes.sum())) + np.repeat(begin - (ends - sizes), sizes)]
        return single, np.bincount(text, weights=sizes, minlength=n_texts).astype(np.int64), ids


_encoders: dict[str, UnitEncoder] = {}  # of this worker process


def encoder_of(path: str) -> UnitEncoder:
    """The process's encoder, which tasks leave to those after them: a tokenizer, and units in arrays of some 70 MB at most."""
    if path not in _encoders:
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


SPREAD = np.uint64(0x9E3779B97F4A7C15)


#: In the place of a pair that is not live.
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _pairs(seq: np.ndarray, live: np.ndarray) -> tuple[np.ndarray | None, np.ndarray]:
    """The live places and their pairs, the left symbol in the upper half. Where most are live all pairs are given, and no places: one sweep
    is cheaper than many single ones."""
    if 4 * np.count_nonzero(live) < 3 * len(seq):
        at = np.flatnonzero(live)
        return at, seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1]
    code = np.empty(len(seq) - 1, "<u8")
    half = code.view("<u4").reshape(-1, 2)
    half[:, 0], half[:, 1] = seq[1:], seq[:-1]
    code[~live[:-1]] = _NONE
    return None, code


def _compatible(pairs: np.ndarray, n_symbols: int) -> np.ndarray:
    """Those of ``pairs`` that take no place of one before them: none begins with a symbol that another ends with."""
    begins, ends = bytearray(n_symbols), bytearray(n_symbols)
    lefts, rights = (pairs >> np.uint64(32)).view(np.int64), (pairs & np.uint64(0xFFFFFFFF)).view(np.int64)
    begun, ended = np.frombuffer(begins, bool), np.frombuffer(ends, bool)
    chosen, i = [], 0
    while i < len(pairs):
        j = max(2 * i, i + 1000)
        left, right = lefts[i:j], rights[i:j]
        free = np.flatnonzero(~(ended[left] | begun[right]))  # most of those that stand back against the runs before
        for k, a, b in zip((free + i).tolist(), left[free].tolist(), right[free].tolist(), strict=True):
            if not (ends[a] or begins[b] or a == b and (begins[a] or ends[b])):
                begins[a] = ends[b] = 1
                chosen.append(k)
        i = j
    return pairs[chosen]


def re_pair(ids: np.ndarray, counts: np.ndarray, first: int, least: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (pairs, the k-th makes symbol ``first + k``), symbols and symbols per document.

    Each round replaces the most frequent pairs, down to 1/64 of the first one's count, that do not compete for a symbol's place: none
    begins with a symbol that another ends with. Rounds end when no pair inside a document is found ``least`` times any more.
    """
    seq, counts = np.array(ids, np.uint32), np.asarray(counts, np.int64)
    ends = np.cumsum(counts)[counts > 0] - 1  # the documents' last symbols, which begin no pair
    live = np.ones(len(seq), bool)  # places whose pair may be frequent; a pair once rare stays so, as new pairs have new symbols
    live[ends] = False
    rules: list[np.ndarray] = []
    n_rules = n_rounds = 0
    while live.any():
        at, code = _pairs(seq, live)
        if n_rounds % 4 == 0:  # drop rare pairs by counts of their hashes; in every round that would cost more than it saves
            bits = min(20, len(code).bit_length())
            bucket = (code * SPREAD >> np.uint64(64 - bits)).view(np.int64)
            often = (np.bincount(bucket, minlength=1 << bits) >= least)[bucket]
            del bucket
            if at is None and 4 * np.count_nonzero(often) > 3 * len(code):
                live[:-1] &= often
                code[~often] = _NONE
            else:
                at = np.arange(len(code)) if at is None else at
                live[at[~often]] = False
                at, code = at[often], code[often]
            del often
        n_rounds += 1
        ranked = np.sort(code)
        ranked = ranked[: np.searchsorted(ranked, _NONE)]
        edge = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        found = np.diff(np.append(edge, len(ranked)))
        best = np.flatnonzero(found >= max(least, int(found.max(initial=0)) // 64))
        if not len(best):
            break
        best = best[np.argsort(-found[best], kind="stable")]
        table = np.sort(_compatible(ranked[edge[best]], first + n_rules))
        del ranked, edge, found
        place = (table * SPREAD >> np.uint64(46)).view(np.int64)
        marked = np.zeros(1 << 18, bool)
        marked[place] = True
        rule_at = np.zeros(1 << 18, np.int32)
        rule_at[place] = np.arange(len(table))
        place = (code * SPREAD >> np.uint64(46)).view(np.int64)
        may = np.flatnonzero(marked[place])
        where, own, which = may if at is None else at[may], code[may], rule_at[place[may]]
        del at, code, may, place
        other = np.flatnonzero(table[which] != own)  # several rules may share a place
        which[other] = np.minimum(np.searchsorted(table, own[other]), len(table) - 1)
        hit = table[which] == own
        where, which = where[hit], which[hit]
        follows = np.concatenate([[False], where[:-1] + 1 == where[1:]])  # runs of one symbol: every other place counts
        if follows.any():
            run = np.arange(len(where)) - np.maximum.accumulate(np.where(follows, 0, np.arange(len(where))))
            where, which = where[run % 2 == 0], which[run % 2 == 0]
        seq[where] = (first + n_rules + which).astype(np.uint32)
        live[where] = live[np.maximum(where - 1, 0)] = True
        stays = np.ones(len(seq), bool)
        stays[where + 1] = False
        seq, live = seq[stays], live[stays]
        ends -= np.searchsorted(where, ends)  # where a document's last symbol went into a pair, the pair is the last one
        live[ends] = False
        rules.append(table)
        n_rules += len(table)
    all_ = np.concatenate(rules) if rules else np.zeros(0, np.uint64)
    symbols = np.zeros(len(counts), np.int64)
    symbols[counts > 0] = np.diff(ends, prepend=-1)
    return np.column_stack([all_ >> np.uint64(32), all_ & np.uint64(0xFFFFFFFF)]).astype(np.uint32), seq, symbols


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    out = np.ones(first + len(rules), np.uint32)
    needs = rules.max(axis=1, initial=0)
    i = 0
    while i < len(rules):  # rules only use symbols of earlier rounds; a round ends where one of its own would be used
        own = needs[i:] >= first + i
        j = i + int(own.argmax()) if own.any() else len(rules)
        out[first + i : first + j] = out[rules[i:j, 0]] + out[rules[i:j, 1]]
        i = j
    return out


def pack(ids: np.ndarray, counts: np.ndarray, first: int, **parameters) -> bytes:
    """One shard of whole documents. ``first``: the first nonterminal, above every id."""
    first = max(first, int(ids.max(initial=0)) + 1)
    rules, seq, symbols = re_pair(ids, counts, first, **parameters)
    bits = max(16, (first + len(rules) - 1).bit_length())
    head = np.array([first, len(rules), len(counts), len(seq), bits, 0], "<u4")
    parts = [head, rules.astype("<u4"), expansion_lengths(rules, first)[first:].astype("<u4"), symbols.astype("<u4"), counts.astype("<u4"), (seq & np.uint32(0xFFFF)).astype("<u2")]
    parts += [np.packbits((seq >> np.uint32(k) & np.uint32(1)).astype(bool)) for k in range(16, bits)]
    return MAGIC + b"".join(p.tobytes() for p in parts)


#: Tokens of an expansion that a reader keeps at hand.
SHORT = 64


class Shard:
    """Reads a shard; documents can be decoded alone, and any range of a document's tokens too."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        self.first, n_rules, n_docs, n_symbols, bits, _ = np.frombuffer(data, "<u4", 6, 4).tolist()
        at = 28
        take = lambda n, kind: (np.frombuffer(data, kind, n, at), at + n * np.dtype(kind).itemsize)
        rules, at = take(2 * n_rules, "<u4")
        self.rules = rules.reshape(-1, 2)
        lengths, at = take(n_rules, "<u4")
        self.symbols, at = take(n_docs, "<u4")
        self.tokens, at = take(n_docs, "<u4")
        low, at = take(n_symbols, "<u2")
        self.seq = low.astype(np.uint32)
        for k in range(16, bits):
            plane, at = take(-(-n_symbols // 8), "u1")
            self.seq |= np.unpackbits(plane, count=n_symbols).astype(np.uint32) << np.uint32(k)
        self.lengths = np.concatenate([np.ones(self.first, np.uint32), lengths])
        self.bounds = np.concatenate([[0], np.cumsum(self.symbols, dtype=np.int64)])

    @functools.cached_property
    def short(self) -> tuple[np.ndarray, np.ndarray]:
        """The expansions of all symbols of at most ``SHORT`` tokens, one after the other, and where each begins (-1: longer)."""
        own = np.flatnonzero(self.lengths <= SHORT)
        at = np.full(len(self.lengths), -1, np.int64)
        at[own] = np.cumsum(self.lengths[own], dtype=np.int64) - self.lengths[own]
        return self._by_depth(own.astype(np.uint32)), at

    def expand(self, seq: np.ndarray) -> np.ndarray:
        """Short symbols of a long sequence are copied from a table of their expansions."""
        if len(seq) < len(self.rules):  # the table would cost more
            return self._by_depth(seq)
        tokens, at = self.short
        size = self.lengths[seq].astype(np.int64)
        begin, ends = at[seq], np.cumsum(size)
        long = np.flatnonzero(begin < 0)
        begin[long] = 0
        place = np.arange(int(size.sum()))
        place += np.repeat(begin - (ends - size), size)
        if not len(long):
            return tokens[place]
        out = tokens[np.minimum(place, len(tokens) - 1, out=place)]
        n = size[long]
        out[np.arange(int(n.sum())) + np.repeat(ends[long] - np.cumsum(n), n)] = self._by_depth(seq[long])
        return out

    def _by_depth(self, seq: np.ndarray) -> np.ndarray:
        """All nonterminals of one depth at once, until none is left; lengths tell where the halves of each go."""
        size = self.lengths[seq].astype(np.int64)
        out = np.empty(int(size.sum()), np.uint32)
        at = np.cumsum(size) - size
        while len(seq):
            rule = seq >= self.first
            out[at[~rule]] = seq[~rule]
            at, pairs = at[rule], self.rules[seq[rule] - np.uint32(self.first)]
            at = np.concatenate([at, at + self.lengths[pairs[:, 0]]])
            seq = pairs.T.ravel()
        return out

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.seq[self.bounds[k] : self.bounds[k + 1]])

    def slice(self, k: int, start: int, stop: int) -> np.ndarray:
        """Tokens start to stop of document k: only the symbols that hold them are expanded."""
        own = self.seq[self.bounds[k] : self.bounds[k + 1]]
        ends = np.cumsum(self.lengths[own], dtype=np.int64)
        a, b = int(np.searchsorted(ends, start, side="right")), int(np.searchsorted(ends, stop))
        skip = start - (int(ends[a - 1]) if a else 0)
        return self.expand(own[a : b + 1])[skip : skip + stop - start]


SHARD_SCHEMA = "task int, shard int, first_doc long, last_doc long, n_docs long, n_tokens long, doc_ids array<long>, payload binary"


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int = 2, task_mb: int = 8, max_tasks: int = 50_000, shard_tokens: int = 6_000_000, first: int = 50_257, **parameters) -> None:
    """Writes the ids of ``documents`` (doc_id, text; other columns are left out) in ascending doc_id order into folder ``path``.

    A null text is empty; each document ends with ``end_id``. Null ids come first; rows of one id follow each other in the order of a
    hash of their texts, then of the texts. Rows are dealt by ranges of id and hash, so one repeated id does not fill one task. A task takes
    about ``task_mb`` of text, more where that would make over ``max_tasks``. A shard ends at ``shard_tokens`` tokens, which bounds a
    task's memory whatever it is dealt; a longer document is a shard alone.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("__tie", F.xxhash64("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("b")).first()["b"]
    tasks = min(max_tasks, max(1, -(-total // (task_mb << 20))))
    order = ["doc_id", "__tie", "text"]
    dealt = docs.repartitionByRange(tasks, "doc_id", "__tie").sortWithinPartitions(*order).drop("__tie")
    dealt.mapInArrow(_packer(tokenizer, end_id, shard_tokens, first, parameters), SHARD_SCHEMA).write.parquet(path)


def _packer(tokenizer: str, end_id: int, shard_tokens: int, first: int, parameters: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer)
        task, shard = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list[pa.Array] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal shard, held
            n, flat, own = np.concatenate(counts), np.concatenate(ids), pa.concat_arrays(names).cast(pa.int64())
            for x in (ids, counts, names):
                x.clear()
            known = own.drop_null()
            row = [[task], [shard], [known[0] if len(known) else None], [known[-1] if len(known) else None], [len(n)], [len(flat)], [own], [pack(flat, n, first, **parameters)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            shard, held = shard + 1, 0
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["task", "shard", "first_doc", "last_doc", "n_docs", "n_tokens", "doc_ids", "payload"])

        for batch in batches:
            for part, data, offsets in text_slices(batch, "text"):
                flat, n = encoder.encode(data, offsets)
                flat, n = np.insert(flat, np.cumsum(n), np.uint32(end_id)), n + 1
                ends, i = np.cumsum(n), 0
                while i < len(n):
                    begin = ends[i] - n[i]
                    j = int(np.searchsorted(ends, begin + shard_tokens - held, side="right"))
                    if j <= i and held:
                        yield flush()
                        continue
                    j = max(i + 1, j)
                    ids.append(flat[begin : ends[j - 1]])
                    counts.append(n[i:j])
                    names.append(part.column("doc_id").slice(i, j - i))
                    held, i = held + len(ids[-1]), j
        if names:
            yield flush()

    return releasing(run)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start (tokens of all documents before it), n_tokens, ids_crc32, and ``ids`` on demand.

    Starts come from the shards' token counts: summed within tasks, and over the tasks' totals (one row per task).
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = shards.select("task", "shard", "n_tokens")
    tasks = sizes.groupBy("task").agg(F.sum("n_tokens").alias("n"))
    before = tasks.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("before"))
    inside = sizes.withColumn("inside", F.sum("n_tokens").over(Window.partitionBy("task").orderBy("shard")) - F.col("n_tokens"))
    starts = inside.join(before, "task").select("task", "shard", (F.col("before") + F.col("inside")).alias("begin"))
    schema = "task int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    docs = shards.select("task", "shard", "doc_ids", "payload").mapInArrow(_reader(with_ids), schema)
    return docs.join(starts, ["task", "shard"]).select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def _reader(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard(batch.column("payload")[row].as_py())
                ends = np.cumsum(shard.tokens, dtype=np.int64)
                i = 0
                while i < len(ends):  # whole documents of a million tokens together
                    begin = ends[i:] - shard.tokens[i:]
                    j = max(i + 1, int(np.searchsorted(ends, begin[0] + 1_000_000, side="right")))
                    begin, tokens = begin[: j - i], shard.tokens[i:j].astype(np.int64)
                    flat = shard.expand(shard.seq[shard.bounds[i] : shard.bounds[j]])
                    places = list(zip((begin - begin[0]).tolist(), (begin - begin[0] + tokens).tolist(), strict=True))
                    raw = flat.astype("<u4").tobytes()
                    crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in places]
                    columns = [pa.array([batch.column(c)[row].as_py()] * len(crc), pa.int32()) for c in ("task", "shard")]
                    columns += [batch.column("doc_ids")[row].values.slice(i, j - i), pa.array(begin), pa.array(tokens), pa.array(crc, pa.int64())]
                    names = ["task", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([flat[a:b].astype(np.int64) for a, b in places], pa.list_(pa.int64())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)
                    i = j

    return releasing(run)
