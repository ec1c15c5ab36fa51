"""Byte-level BPE by pieces: texts cut before spaces, pieces looked up in tables, only new ones encoded.

The library never joins across the cuts used here. A piece starts at the text's start, at white
space after another character, at the last character of a run of white space before another
character, and after white space other than a space. A text with other Unicode white space, rare
control characters or an added token goes to the library as a whole, so the ids are the library's
for every text.

Both tiers are direct-mapped tables from a 64-bit hash of the piece to its ids: the first is
built once from a bounded sample and broadcast, the second belongs to a Python worker, has a
fixed number of slots, and a new piece takes the slot of an old one.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from ratingloom.llm.text import SPACE, slices, spans_hash

_U = np.uint64
FREQUENT_SLOTS = 1 << 18
WORKER_SLOTS = 1 << 20
POOL_IDS = 1 << 22
SEPARATE = 64  # bytes from which a piece is encoded on its own


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable Latin-1 characters stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each piece."""
    n = len(data)
    white = SPACE[data]
    before, after = np.zeros(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = white[:-1], white[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    space = data == 0x20
    led = np.zeros(n, bool)  # by white space other than a space
    led[1:] = before[1:] & ~space[:-1]
    begins = white & (~before | ~after) | ~white & led
    begins[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(begins)
    return starts, np.append(starts[1:], n)


def odd_texts(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> np.ndarray:
    """Numbers of the texts that need the library as a whole."""
    found = [np.flatnonzero((data >= 0x1C) & (data <= 0x1F))]
    pad = np.concatenate([data, np.zeros(2, np.uint8)])
    two = lambda at: pad[at + 1].astype(np.int64) << 8 | pad[at + 2]
    at = np.flatnonzero(data == 0xC2)
    found.append(at[np.isin(pad[at + 1], (0x85, 0xA0))])
    at = np.flatnonzero((data >= 0xE1) & (data <= 0xE3))
    white = two(at)
    found.append(at[(white == 0x9A80) | (white >= 0x8080) & (white <= 0x808A) | np.isin(white, (0x80A8, 0x80A9, 0x80AF, 0x819F))])
    whole = data.tobytes()
    for token in special:
        place = whole.find(token)
        while place >= 0:
            found.append(np.array([place]))
            place = whole.find(token, place + 1)
    return np.unique(np.searchsorted(offsets, np.concatenate(found), "right") - 1)


class Table:
    """Direct-mapped table: hash of a piece to the place and number of its ids in a pool."""

    def __init__(self, slots: int, pool: int):
        self.slots, self.pool = slots, pool
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(self.slots, _U)
        self.place = np.zeros(self.slots, np.int64)
        self.size = np.zeros(self.slots, np.int32)
        self.ids = np.zeros(0, np.int32)  # the first ``used`` are in use
        self.used = 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each hash, and whether the slot holds it."""
        slot = (hashes % _U(self.slots)).astype(np.int64)
        return slot, (self.keys[slot] == hashes) & (self.size[slot] > 0)

    def add(self, hashes: np.ndarray, sizes: np.ndarray, place: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > self.pool:
            self.clear()
        slot = (hashes % _U(self.slots)).astype(np.int64)
        # of pieces with the same slot one must win in all three arrays
        slot, own = np.unique(slot, return_index=True)
        self.place[slot], self.size[slot], self.keys[slot] = self.used + place[own], sizes[own], hashes[own]
        end = self.used + len(ids)
        if end > len(self.ids):
            grown = np.zeros(max(end, min(2 * end, self.pool)), np.int32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : end] = ids
        self.used = end


class Encoder:
    """Ids of whole texts as the library gives them. ``frequent``: (hashes, sizes, places, ids) of the first tier.
    Without ``specials`` the strings of special tokens are plain text."""

    def __init__(self, path: str, frequent: tuple[np.ndarray, ...] | None = None, specials: bool = True):
        from tokenizers import Tokenizer

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        self.by_pieces = (
            pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space", True)
            and not spec.get("normalizer")
            and not model.get("dropout")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
        )
        self.fast = self._fast(model) if self.by_pieces else None
        if not specials:
            self.library.encode_special_tokens = True
            self.special = []
        self.tiers = [Table(WORKER_SLOTS, POOL_IDS)]
        if frequent is not None and len(frequent[0]):
            first = Table(FREQUENT_SLOTS, len(frequent[3]))
            first.add(*frequent)
            self.tiers.insert(0, first)

    def _fast(self, model: dict):
        """The same merges in an encoder without per-call overhead, if it is there and the vocabulary is ordered by merges."""
        try:
            import tiktoken
        except ImportError:
            return None

        letters = byte_letters()
        try:
            ranks = {bytes(letters[c] for c in token): i for token, i in model["vocab"].items() if token not in {s.decode() for s in self.special}}
            merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
            ids = [model["vocab"]["".join(m)] for m in merges]
        except KeyError:
            return None
        if ids != sorted(ids) or len(ranks) != 256 + len(ids) or min(ids) < 256:
            return None
        # fixed values: the split pattern of byte-level vocabularies
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.line_end = ranks[b"\n"]
        starts = np.zeros(len(ranks), bool)
        starts[[i for token, i in ranks.items() if token[:1] == b" "]] = True
        self.starts = starts
        return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return cut(data, offsets)

    def odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return odd_texts(data, offsets, self.special)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids."""
        found = [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]
        return np.array([len(x) for x in found], np.int64), np.array([i for x in found for i in x], np.int64)

    def encode_pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Sizes and places of the ids of different pieces, and the ids. Short pieces of ASCII or Latin letters
        without white space but for one space at the start are encoded in two calls: if they start with a
        space, so does the first of each one's tokens and no other; if not, they are joined by line ends,
        which are tokens of their own."""
        length = ends - starts
        begin = np.cumsum(length) - length
        letters = data[np.repeat(starts - begin, length) + np.arange(length.sum())]
        sizes, place = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        ids, plain = np.zeros(0, np.int32), np.zeros(len(starts), bool)
        if self.fast is not None and len(starts):
            white = SPACE[letters]
            led = letters[begin] == 0x20
            bad = (letters > 0xC3) | white
            bad[begin[led]] = False
            plain = (np.add.reduceat(bad.astype(np.int32), begin) == 0) & (length > led) & (length < SEPARATE)
            for kind in (plain & led, plain & ~led):
                text = letters[np.repeat(kind, length)]
                if not led[kind].all():
                    text = np.insert(text, np.cumsum(length[kind])[:-1], 0x0A)
                found = self.fast.encode_to_numpy(text.tobytes().decode(), disallowed_special=()).astype(np.int32)
                if led[kind].all():
                    first = np.flatnonzero(self.starts[found])
                    size = np.diff(np.append(first, len(found)))
                else:
                    line = np.flatnonzero(found == self.line_end)
                    first = np.append(0, line + 1)
                    size = np.append(line, len(found)) - first
                if len(first) == kind.sum():
                    place[kind], sizes[kind] = len(ids) + first, size
                    ids = np.concatenate([ids, found])
                else:
                    plain &= ~kind
        alone = np.flatnonzero(~plain)
        if len(alone):
            size, more = self.encode_texts([data[starts[i] : ends[i]].tobytes().decode() for i in alone.tolist()])
            sizes[alone], place[alone] = size, len(ids) + np.cumsum(size) - size
            ids = np.concatenate([ids, more.astype(np.int32)])
        return sizes, place, ids

    def encode(self, column: pa.Array, keep_ids: bool):
        """Yields for runs of texts: first row, row after the last, sizes of the texts, their ids or None."""
        for at, to, data, offsets in slices(column):
            texts = to - at
            if not self.by_pieces:
                sizes, ids = self.encode_texts([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in range(texts)])
                yield at, to, sizes, ids if keep_ids else None
                continue
            odd = self.odd(data, offsets)
            starts, ends = self.cut(data, offsets)
            owner = np.searchsorted(offsets, starts, "right") - 1
            if len(odd):
                keep = ~np.isin(owner, odd)
                starts, ends, owner = starts[keep], ends[keep], owner[keep]
            hashes = spans_hash(data, starts, ends)
            sizes, place, pool = self._look_up(data, starts, ends, hashes, keep_ids)
            counts = np.bincount(owner, sizes, texts).astype(np.int64) if len(owner) else np.zeros(texts, np.int64)
            ids = None
            if keep_ids:
                begin = np.cumsum(sizes) - sizes
                ids = pool[np.repeat(place - begin, sizes) + np.arange(sizes.sum())]
            if len(odd):
                whole, odd_ids = self.encode_texts([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in odd.tolist()])
                if keep_ids:
                    parts = np.split(ids, np.cumsum(counts)[:-1])
                    for i, part in zip(odd.tolist(), np.split(odd_ids, np.cumsum(whole)[:-1])):
                        parts[i] = part
                    ids = np.concatenate(parts)
                counts[odd] = whole
            yield at, to, counts, ids

    def _look_up(self, data, starts, ends, hashes, keep_ids):
        """Size and place of each piece's ids in the returned pool."""
        n = len(hashes)
        sizes, place, missing = np.zeros(n, np.int64), np.zeros(n, np.int64), np.arange(n)
        pools, base = [], 0
        for table in self.tiers:
            slot, hit = table.find(hashes[missing])
            rows, slot = missing[hit], slot[hit]
            sizes[rows], place[rows] = table.size[slot], table.place[slot] + base
            missing = missing[~hit]
            pools.append(table.ids[: table.used])
            base += table.used
        if len(missing):
            new, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            rows = missing[first]
            size, begin, ids = self.encode_pieces(data, starts[rows], ends[rows])
            sizes[missing], place[missing] = size[which], begin[which] + base
            pools.append(ids)
            self.tiers[-1].add(new, size, begin, ids)
        return sizes, place, np.concatenate(pools) if keep_ids else None


class SpaceEncoder(Encoder):
    """Ids of a sentencepiece model that puts a space before a text, for texts given with that space.

    A BPE model in which no piece has a space after another character never joins across the place
    before such a space, so the segments between those places go through the tables. Any other model
    gets whole texts. Every text must begin with a space or be empty, which has no ids.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.path, self.special, self.fast = path, [], None
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.by_pieces = self._plain(path) and not any("\u2581" in name.lstrip("\u2581") for name in names)
        self.space = self.library.piece_to_id("\u2581")
        self.by_pieces &= not self.library.is_unknown(self.space)
        self.tiers = [Table(WORKER_SLOTS, POOL_IDS)]

    @staticmethod
    def _plain(path: str) -> bool:
        """Whether the file says that the model is BPE, puts a space first and changes nothing else."""
        try:
            from sentencepiece import sentencepiece_model_pb2 as form
        except ImportError:
            return False
        model = form.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        rule, kind = model.normalizer_spec, model.trainer_spec
        spaces = rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces
        return kind.model_type == kind.BPE and not rule.precompiled_charsmap and spaces and not kind.treat_whitespace_as_suffix

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        return starts, np.append(starts[1:], len(data))

    def odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return np.zeros(0, np.int64)

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # the library puts the first space back; alone it gives nothing for it
        found = [[self.space] if t == " " else x for t, x in zip(texts, self.library.encode([t[1:] for t in texts], num_threads=1))]
        return np.array([len(x) for x in found], np.int64), np.array([i for x in found for i in x], np.int64)


def frequent_pieces(encoder: Encoder, column: pa.Array, most: int) -> tuple[np.ndarray, ...] | None:
    """The ``most`` most frequent pieces of some texts as (hashes, sizes, places, ids) of a first tier."""
    if not encoder.by_pieces:
        return None
    hashes, counts, examples = [], [], []
    for _, _, data, offsets in slices(column):
        starts, ends = cut(data, offsets)
        new, first, count = np.unique(spans_hash(data, starts, ends), return_index=True, return_counts=True)
        kept = np.argsort(-count, kind="stable")[:most]
        hashes.append(new[kept])
        counts.append(count[kept])
        examples += [data[starts[i] : ends[i]].tobytes() for i in first[kept].tolist()]
    if not examples:
        return None
    new, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    total = np.bincount(which, np.concatenate(counts))
    best = np.lexsort((new, -total))[:most]
    raw = [examples[i] for i in first[best].tolist()]
    ends = np.cumsum([len(x) for x in raw], dtype=np.int64)
    sizes, place, ids = encoder.encode_pieces(np.frombuffer(b"".join(raw), np.uint8), np.append(0, ends[:-1]), ends)
    return new[best], sizes, place, ids
