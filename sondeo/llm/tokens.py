"""Token ids of whole texts, as those of the tokenizers library."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

#: Bytes of parts and their ids that a task remembers; beyond it, it starts anew. Characters, and parts, that are encoded in one call; characters that are looked up at a time.
MEMO_BYTES, CALL_CHARS, CALL_PARTS, LOT_CHARS = 96 << 20, 1 << 20, 500, 4 << 20
#: A space between white space, or after it at the end: the split before the space may not be a split of the tokenizer.
SPACED = re.compile(r"\s \s|\s $")
#: Where nothing is unusual, the tokenizer too keeps runs of these letters apart from runs of all else, a space in front of either.
#: They are A-Z, a-z and U+00C0 to U+024F without U+00D7 and U+00F7; where nothing is unusual, all bytes from 0x80 on are theirs.
WORD = re.compile(rb" ?(?:[A-Za-z]|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF]|[\xC4-\xC8][\x80-\xBF]|\xC9[\x80-\x8F])+")
_IS_LETTER, _IS_WHITE = (np.array([i in them for i in range(256)]) for them in ({*range(65, 91), *range(97, 123), *range(128, 256)}, {*range(9, 14), *range(28, 33)}))
#: What may split elsewhere; it is looked for in bytes, and tests compare that with this.
UNUSUAL = re.compile(r"['\x80-\xBF×÷\u0250-\U0010FFFF]|\s\s| $")
Encoder = Callable[[Iterable[str]], list[np.ndarray]]


def split_at_spaces(spec: dict) -> bool:
    """Whether a tokenizer surely splits before a space that something other than white space follows: byte-level with the usual pattern, nothing normalised or dropped at random."""
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    usual = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return usual and not spec.get("normalizer") and not spec.get("truncation") and model.get("type") == "BPE" and not model.get("dropout")


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level tokenizers write bytes: themselves if they can be seen, else letters from U+0100 on in their order."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in seen)
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(others)}


def _of_words(spec: dict) -> tuple | None:
    """A tokenizer of the same model that splits at line feeds only, and its id of these; None if the model has none.

    It keeps no cache of its own: what it is given has not been met before.
    """
    import tokenizers

    model, line_feed = spec["model"], byte_letters()[10]
    options = ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    bare = tokenizers.Tokenizer(tokenizers.models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **{k: model[k] for k in options if model.get(k)}))
    bare.pre_tokenizer = tokenizers.pre_tokenizers.Split(line_feed, "isolated")
    end_of_run = bare.token_to_id(line_feed)
    return None if end_of_run is None else (bare, end_of_run)


def _tokenizers(vocabulary: str) -> tuple:
    """The tokenizer, the texts of its added tokens, and _of_words() if it splits at spaces; made once per worker process and vocabulary."""
    import tokenizers

    made = tokenizers.__dict__.setdefault("_of_vocabularies", {})  # functions travel by value: their own module's names don't outlive a task
    if vocabulary not in made:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        own = tokenizers.Tokenizer.from_file(vocabulary)
        spec = json.loads(own.to_str())
        made[vocabulary] = own, [t["content"] for t in spec["added_tokens"]], _of_words(spec) if split_at_spaces(spec) else None
    return made[vocabulary]


def unusual_bytes(raw: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes hold an apostrophe or begin a character that UNUSUAL names."""
    after = np.append(raw[1:], np.uint8(0))
    return (raw == 0x27) | (raw == 0xC2) | (raw >= 0xCA) | ((raw == 0xC9) & (after >= 0x90)) | ((raw == 0xC3) & ((after == 0x97) | (after == 0xB7)))


def unusual_texts(raw: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Which texts hold what UNUSUAL finds; raw: their UTF-8 bytes one after the other, edge: where each begins, and the end.

    White space of two texts that meet may mark the first of them too.
    """
    white = _IS_WHITE[raw]
    odd = unusual_bytes(raw)
    odd[:-1] |= white[:-1] & white[1:]
    last = edge[1:][edge[1:] > edge[:-1]] - 1
    odd[last] |= raw[last] == 32
    return np.diff(np.searchsorted(np.flatnonzero(odd), edge)) > 0


def part_starts(raw: np.ndarray, edge: np.ndarray, unusual: bool) -> np.ndarray:
    """Where the parts of such texts begin.

    A part begins at each space and between a letter and another character. If any text is unusual, what stands from one
    space to the next and holds what UNUSUAL finds is one part.
    """
    space, letter = raw == 32, _IS_LETTER[raw]
    begins = edge[:-1][edge[:-1] < edge[1:]]  # of texts that are not empty
    start = space.copy()
    start[1:] |= (letter[1:] != letter[:-1]) & ~space[:-1]
    start[begins] = True
    if unusual:
        chunk = space
        chunk[begins] = True
        white = _IS_WHITE[raw]
        odd = unusual_bytes(raw)
        odd[:-1] |= white[:-1] & white[1:] & ~chunk[1:]
        number = np.cumsum(chunk) - 1
        whole = np.zeros(len(raw), bool)
        whole[number[odd]] = True
        start &= chunk | ~whole[number]
    return np.flatnonzero(start)


def _edges(data: list[bytes]) -> np.ndarray:
    return np.cumsum([0, *map(len, data)])


def _bytes_of(parts: pa.Array) -> list[bytes]:
    if not len(parts):
        return []
    edge, flat = np.frombuffer(parts.buffers()[1], np.int32)[: len(parts) + 1].tolist(), parts.buffers()[2].to_pybytes()
    return [flat[a:b] for a, b in zip(edge, edge[1:], strict=False)]


class _Table:
    """Parts that a task has met, and their ids one after the other."""

    def __init__(self) -> None:
        self._begin_anew()

    def _begin_anew(self) -> None:
        self.row: dict[bytes, int] = {}
        self.size = self.n_ids = 0
        self.ids, self.first, self.count = np.zeros(1 << 16, "<u4"), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def forget_if_over(self, most: int) -> None:
        if self.size > most:
            self._begin_anew()

    def add(self, parts: list[bytes], counts: np.ndarray, ids: np.ndarray) -> None:
        n, more = len(self.row), len(parts)
        while n + more > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.row.update(zip(parts, range(n, n + more), strict=True))
        self.first[n : n + more] = self.n_ids + np.cumsum(counts) - counts
        self.count[n : n + more] = counts
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        self.size += 150 * more + sum(map(len, parts)) + 4 * len(ids)

    def ids_of(self, known: list[bytes], which: np.ndarray, learn: Callable[[list[bytes]], None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known[which], and where those of each begin (and the end). learn: adds parts that are not here yet."""
        if missing := [p for p in known if p not in self.row]:
            learn(missing)
        row = np.fromiter(map(self.row.__getitem__, known), np.int64, len(known))[which]
        count = self.count[row]
        ends = np.concatenate([[0], np.cumsum(count)])
        return self.ids[np.repeat(self.first[row] - ends[:-1], count) + np.arange(ends[-1])], ends


def encoder(vocabulary: str) -> Encoder:
    """A function from texts to their ids (uint32), for one task: what it remembers goes with it.

    All ids come from the tokenizers library. A text falls apart where the tokenizer surely splits it: into runs of letters
    and of other characters, or, around anything unusual, before its spaces. Arrow tells the different parts of some
    megabytes of texts; one that the task has met before is not encoded again, and ids are gathered by arrays.
    Runs of letters go to the library's model without being split once more. Texts with white space in
    which a space is not a split, with strings of added tokens, or of tokenizers that don't split at spaces are encoded whole.
    """
    own, added, of_words = _tokenizers(vocabulary)
    in_parts, letters = of_words is not None, byte_letters()
    bare, end_of_run = of_words or (None, None)
    table = _Table()

    def in_calls(texts: list[str]) -> Iterable[np.ndarray]:
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= CALL_CHARS):
                chars += len(texts[end])
                end += 1
            for e in own.encode_batch_fast(texts[at:end], add_special_tokens=False):
                yield np.array(e.ids, "<u4")
            at = end

    def learn(parts: list[bytes]) -> None:
        words, others = [], []
        for p in parts:
            (words if WORD.fullmatch(p) else others).append(p)
        for a in range(0, len(words), CALL_PARTS):
            some = words[a : a + CALL_PARTS]
            ids = np.array(bare.encode_batch_fast([b"\n".join(some).decode("latin-1").translate(letters)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.append(np.flatnonzero(ids == end_of_run), len(ids))
            table.add(some, np.diff(ends, prepend=-1) - 1, ids[ids != end_of_run])
        found = list(in_calls([p.decode() for p in others]))
        if found:
            table.add(others, np.array([len(x) for x in found], np.int64), np.concatenate(found))

    def encode(texts: Iterable[str]) -> list[np.ndarray]:
        texts = list(texts)
        out: list = [None] * len(texts)
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end]) <= LOT_CHARS):
                chars += len(texts[end])
                end += 1
            lot, at = range(at, end), end
            data = [texts[i].encode() for i in lot]
            flat, edge = b"".join(data), _edges(data)
            unusual = unusual_texts(np.frombuffer(flat, np.uint8), edge)
            whole = [i for i, odd in zip(lot, unusual.tolist(), strict=True) if not in_parts or odd and SPACED.search(texts[i]) or any(a in texts[i] for a in added)]
            for i, ids in zip(whole, in_calls([texts[i] for i in whole]), strict=True):
                out[i] = ids
            if whole:
                lot = [i for i in lot if out[i] is None]
                data = [texts[i].encode() for i in lot]
                flat, edge = b"".join(data), _edges(data)
            table.forget_if_over(MEMO_BYTES)
            first = part_starts(np.frombuffer(flat, np.uint8), edge, bool(unusual.any()))
            parts = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.append(first, len(flat)).astype(np.int32)), pa.py_buffer(flat)]).dictionary_encode()
            ids, ends = table.ids_of(_bytes_of(parts.dictionary), parts.indices.to_numpy(), learn)
            to = ends[np.searchsorted(first, edge)]
            for i, a, b in zip(lot, to[:-1].tolist(), to[1:].tolist(), strict=True):
                out[i] = ids[a:b]
        return out

    return encode
