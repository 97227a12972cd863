"""A merge vocabulary with vectorised checks, for encoding by proposal and verification."""

from __future__ import annotations

import json
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

END = "\ue000"  # stands for the end-of-word mark inside this module
SUFFIX = "</w>"
NEVER = 1 << 60  # a rank beyond every merge
STOP = 256  # the end of a word, after its bytes
LONG = 64  # words of more bytes are merged one by one


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class MergeTable:
    """Tokens, the two parts each one is merged from, and the rank of that merge.

    A split of a word into tokens is what merging by rank gives exactly when each
    token is what merging gives for its own characters and no two neighbours would
    have merged across their border. That is checked backwards in time: undo the
    later of the two merges that touch the border, and see whether the pair then
    facing each other has a merge that came earlier.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX:
            raise ValueError("needs a merge vocabulary with word ends")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        top = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.token = [""] * top
        for text, i in [*model["vocab"].items(), *self.special.items()]:
            self.token[i] = text
        mark = lambda t: t[: -len(SUFFIX)] + END if t.endswith(SUFFIX) else t
        self.id = {mark(t): i for t, i in model["vocab"].items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([self.id[mark(a)] for a, _ in pairs], dtype=np.int64)
        right = np.array([self.id[mark(b)] for _, b in pairs], dtype=np.int64)
        made = np.array([self.id[mark(a + b)] for a, b in pairs], dtype=np.int64)
        self.top = top
        self.left, self.right, self.rank = (np.full(top, -1, dtype=np.int64) for _ in range(3))
        self.left[made], self.right[made], self.rank[made] = left, right, np.arange(len(made))
        keys = left * top + right
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], order
        self.pair = {int(k): int(r) * top + int(m) for r, (k, m) in enumerate(zip(keys, made, strict=True))}
        self.prefix = {}  # every beginning of a token, with the token it is or -1
        for text, i in self.id.items():
            for stop in range(1, len(text)):
                self.prefix.setdefault(text[:stop], -1)
            self.prefix[text] = i
        self.letter = byte_alphabet()
        self._build_arrays(left, right, made)
        self.sound = np.ones(top, dtype=bool)
        merged = np.flatnonzero(self.rank >= 0)
        ok = self.borders_hold(self.left[merged], self.right[merged], 2 * self.rank[merged])
        for token, fine in zip(merged[np.argsort(self.rank[merged])], ok[np.argsort(self.rank[merged])], strict=True):
            self.sound[token] = fine and self.sound[self.left[token]] and self.sound[self.right[token]]

    def _merge_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or a number beyond every rank."""
        keys = left * self.top + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.key_rank[at], NEVER)

    def borders_hold(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """For each pair of neighbouring tokens, whether merging keeps the border between them.

        Times count double: a merge of rank r that takes the left neighbour away happens
        at 2r, one that takes the right neighbour away at 2r + 1, since equal pairs merge
        from the left.
        """
        held = np.ones(len(left), dtype=bool)
        live = np.arange(len(left))
        left, right = left.copy(), right.copy()
        limit = np.full(len(left), 2 * NEVER) if limit is None else limit.copy()
        while len(live):
            l, r = left[live], right[live]  # noqa: E741
            broken = 2 * self._merge_rank(l, r) < limit[live]
            held[live[broken]] = False
            undo_left = self.rank[l] > self.rank[r]
            done = broken | ((self.rank[l] < 0) & (self.rank[r] < 0))
            a, b = live[~done & undo_left], live[~done & ~undo_left]
            limit[a] = 2 * self.rank[left[a]]
            left[a] = self.right[left[a]]
            limit[b] = 2 * self.rank[right[b]] + 1
            right[b] = self.left[right[b]]
            live = live[~done]
        return held

    def _build_arrays(self, left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        """The same tables as arrays: the tree of token beginnings, the symbols of bytes, and what each merge makes."""
        self.made = made
        byte_of = {c: b for b, c in enumerate(self.letter)} | {END: STOP}
        number = {text: k + 1 for k, text in enumerate(self.prefix)} | {"": 0}
        self.token_at = np.array([-1, *self.prefix.values()], dtype=np.int64)
        steps = np.array([number[t[:-1]] * (STOP + 1) + byte_of[t[-1]] for t in self.prefix], dtype=np.int64)
        order = np.argsort(steps)
        self.steps, self.reached = steps[order], order + 1
        self.prefix = {}
        self.inner = np.array([self.id[c] for c in self.letter], dtype=np.int64)
        self.final = np.array([self.id[c + END] for c in self.letter], dtype=np.int64)

    def propose(self, flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per word, tokens) by greedy longest match of words given as spans of bytes, each with STOP as its last symbol.

        All words go through the tree of token beginnings side by side."""
        words, tokens = [], []
        live, at = np.flatnonzero(end > start), start[end > start]
        while len(live):
            node, place, last = np.zeros(len(live), dtype=np.int64), at.copy(), end[live]
            best, reached = np.full(len(live), -1, dtype=np.int64), at.copy()
            walking = np.arange(len(live))
            while len(walking):
                key = node * (STOP + 1) + flat[place]
                found = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
                on = self.steps[found] == key
                walking, node, place = walking[on], self.reached[found[on]], place[on] + 1
                token = self.token_at[node]
                taken = (token >= 0) & (place != last[walking] - 1)  # the mark is no symbol of its own: the last byte keeps it
                best[walking[taken]], reached[walking[taken]] = token[taken], place[taken]
                more = place < last[walking]
                walking, node, place = walking[more], node[more], place[more]
            words.append(live)
            tokens.append(best)
            more = reached < last
            live, at = live[more], reached[more]
        if not words:
            return np.zeros(len(start), dtype=np.int64), np.zeros(0, dtype=np.int64)
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return np.bincount(word, minlength=len(start)), token[order]

    def merge(self, word: str) -> list[int]:
        """Exact merging of one word in the byte alphabet, the earliest rank first and equal pairs from the left."""
        top, known = self.top, self.pair.get
        ids: list[int] = [self.id[c] for c in word[:-2]] + [self.id[word[-2:]]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        waiting = [(known(a * top + b, NEVER), i) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))]
        heapify(waiting)
        while waiting and waiting[0][0] < NEVER:
            found, i = heappop(waiting)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or known(ids[i] * top + ids[j], NEVER) != found:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = found % top, -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                heappush(waiting, (known(ids[i] * top + ids[after[i]], NEVER), i))
            if before[i] >= 0:
                heappush(waiting, (known(ids[before[i]] * top + ids[i], NEVER), before[i]))
        return [i for i in ids if i >= 0]

    def merge_all(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens per word, tokens) by exact merging of many words at once: every round merges the earliest pair of each word."""
        never = np.iinfo(np.int64).max
        ends = np.cumsum(sizes)
        starts, n = ends - sizes, len(symbols)
        symbol, alive = np.append(symbols, 0), np.ones(n, dtype=bool)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[starts] = n, -1

        def key(left: np.ndarray) -> np.ndarray:
            rank = self._merge_rank(symbol[left], symbol[after[left]])
            return np.where((after[left] < n) & (rank < NEVER), rank << 40 | left, never)

        keys = key(np.arange(n))
        while True:
            first = np.minimum.reduceat(keys, starts)
            first = first[first < never]
            if not len(first):
                break
            at, rank = first & ((1 << 40) - 1), first >> 40
            gone = after[at]
            symbol[at], alive[gone], keys[gone] = self.made[rank], False, never
            after[at] = after[gone]
            inside = at[after[at] < n]
            before[after[inside]] = inside
            keys[at] = key(at)
            earlier = before[at]
            earlier = earlier[earlier >= 0]
            keys[earlier] = key(earlier)
        return np.add.reduceat(alive, starts, dtype=np.int64), symbol[:-1][alive]

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """Tokens per word, the tokens, and how many words needed exact merging."""
        spelled = pa.array(words, pa.string())
        offsets = np.frombuffer(spelled.buffers()[1], dtype=np.int32, count=len(words) + 1).astype(np.int64)
        data = np.frombuffer(spelled.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]]
        sizes = np.diff(offsets)
        end = offsets[1:] + np.arange(1, len(words) + 1)  # each word has one symbol more
        start = end - sizes - 1
        flat = np.full(int(end[-1]) if len(end) else 0, STOP, dtype=np.int64)
        place = np.arange(len(data)) + np.repeat(np.arange(len(words)), sizes)
        flat[place] = data
        counts, tokens = self.propose(flat, start, end)
        word = np.repeat(np.arange(len(words)), counts)
        inner = word[:-1] == word[1:] if len(word) else np.zeros(0, dtype=bool)
        bad = np.zeros(len(words), dtype=bool)
        bad[word[~self.sound[tokens]]] = True
        pairs, back = np.unique(tokens[:-1][inner] * self.top + tokens[1:][inner], return_inverse=True)
        held = self.borders_hold(pairs // self.top, pairs % self.top)
        bad[word[:-1][inner][~held[back]]] = True
        failing = np.flatnonzero(bad)
        if not len(failing):
            return counts, tokens, 0
        symbol = self.inner[np.where(flat == STOP, 0, flat)]
        symbol[end - 2] = self.final[flat[end - 2]]
        merged: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        short = failing[sizes[failing] <= LONG]
        if len(short):
            taken = np.repeat(start[short], sizes[short]) + np.arange(sizes[short].sum()) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
            merged.append((short, *self.merge_all(symbol[taken], sizes[short])))
        for i in failing[sizes[failing] > LONG].tolist():
            ids = np.array(self.merge("".join([self.letter[b] for b in data[offsets[i] : offsets[i + 1]].tolist()]) + END), dtype=np.int64)
            merged.append((np.array([i]), np.array([len(ids)]), ids))
        kept = ~bad[word]
        words_ = np.concatenate([word[kept], *[np.repeat(w, c) for w, c, _ in merged]])
        tokens = np.concatenate([tokens[kept], *[t for _, _, t in merged]])
        return np.bincount(words_, minlength=len(words)), tokens[np.argsort(words_, kind="stable")], len(failing)

    def encode_words(self, words: list[str]) -> tuple[list[list[int]], int]:
        """Ids per word, and how many words needed exact merging."""
        counts, tokens, failed = self.encode_flat(words)
        ends = np.cumsum(counts).tolist()
        return [tokens[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)], failed


FAR = regex.compile(r"[\u0250-\U0010ffff]")
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


class WordEncoder:
    """Texts as words, and the ids of words.

    Texts of Latin letters are put in lower case and split here. Beyond them tables of
    characters differ between releases of the standard, so the pieces between spaces that
    have such are normalised and split by the tokenizer the vocabulary file describes.
    A special mark is a word of its own, told from others by a space before it.
    """

    def __init__(self, path: str):
        self.table = MergeTable(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.proposed = self.failed = 0
        special = sorted(self.table.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not FAR.search(text):
            return SPLIT.findall(text.lower())
        if " " in text:
            return [w for piece in text.split(" ") for w in self._split(piece)]
        text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def words(self, text: str) -> list[str]:
        if not any([mark in text for mark in self.table.special]):
            return self._split(text)
        parts = self.special.split(text)  # marks have odd places
        return [w for k, part in enumerate(parts) for w in ([f" {part}"] if k % 2 else self._split(part))]

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids."""
        marks = [k for k, w in enumerate(words) if w[:1] == " "]
        sizes, ids, failed = self.table.encode_flat([w for w in words if w[:1] != " "] if marks else words)
        self.proposed += len(words)
        self.failed += failed
        if marks:
            own = [self.table.special[words[k][1:]] for k in marks]
            before = np.array(marks) - np.arange(len(marks))  # other words before each mark
            ids = np.insert(ids, np.append(0, np.cumsum(sizes))[before], own)
            sizes = np.insert(sizes, before, 1)
        return sizes, ids


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary file."""
    return WordEncoder(path)
