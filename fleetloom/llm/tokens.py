"""Token ids of whole texts by a byte-level BPE vocabulary file."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa

from fleetloom.llm import words

# A worker remembers the ids of at most about this many pieces, or of one batch's.
REMEMBERED = 200_000
# Texts are worked on in batches of about this many bytes.
BATCH_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _added_tokens(path: str) -> tuple[dict[str, int], bool]:
    """The file's added tokens, and whether each stands for its characters alone and nothing normalises texts."""
    file = json.loads(Path(path).read_text(encoding="utf-8"))
    added = file.get("added_tokens") or []
    plain = not file.get("normalizer") and not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
    return {t["content"]: t["id"] for t in added}, plain


class TokenIds:
    """The ids that an untouched tokenizer of the vocabulary file at ``path`` gives.

    The file's added tokens stand for themselves wherever a text holds them; what lies
    between is encoded apart. No merge crosses a single space between two other
    characters. Texts are cut there, and equal pieces, known by two hashes, are encoded
    once and remembered.
    """

    def __init__(self, path: str):
        self._forget()
        self.added, plain = _added_tokens(path)
        self.marks = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        ranks = Path(path).with_suffix(".tiktoken")
        if plain and ranks.exists():  # the same vocabulary for a faster encoder
            import public_tokenizers
            import tiktoken

            with ranks.open("rb") as lines:
                merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.encode = tiktoken.Encoding(ranks.stem, pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}).encode_ordinary
            self.sizes = np.zeros(max(merges.values()) + 1, dtype=np.int64)
            for token, rank in merges.items():
                self.sizes[rank] = len(token)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self.encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
            self.sizes = self.marks = None

    def _ids(self, text: str) -> list[int]:
        if self.marks is None:
            return self.encode(text)
        parts = self.marks.split(text)
        return [i for k, part in enumerate(parts) for i in ([self.added[part]] if k % 2 else self.encode(part))]

    def _each(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(self._ids(t.decode("utf-8", "replace")), dtype="<u4") for t in texts]

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        space = _SPACE[data]
        single = data == 0x20
        single[1:] &= ~space[:-1]
        single[:-1] &= ~space[1:]
        single[offsets[:-1][offsets[:-1] < len(data)]] = False
        single[offsets[1:][offsets[1:] > 0] - 1] = False
        edges = np.append(single, False)
        edges[offsets] = True
        return np.flatnonzero(edges)

    def of(self, column: pa.Array, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows ``first`` to ``last`` in one array, and where each row's begin and end."""
        data, offsets = words.bytes_of(column, first, last)
        raw = data.tobytes()
        if self.sizes is None or not len(data):
            return self._whole(raw, offsets)
        text = raw.decode("utf-8", "replace")
        if _WIDE_SPACE.search(text) or self.marks is not None and self.marks.search(text):
            return self._whole(raw, offsets)
        cuts = self._cuts(data, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        alone = (data[starts] != 0x20) | _SPACE[data[ends - 1]] | np.isin(starts, offsets)
        single, shared = np.flatnonzero(alone), np.flatnonzero(~alone)
        key, check = (words.byte_spans_hash(data, starts[shared], ends[shared], base) for base in (words.BYTE_BASE, words.OTHER_BASE))
        _, one, which = np.unique(key, return_index=True, return_inverse=True)
        if np.any(check != check[one][which]):  # two pieces with one hash
            return self._whole(raw, offsets)
        at = self._known(raw, key[one], check[one], starts[shared[one]], ends[shared[one]])
        extra = self._each([raw[a:b] for a, b in zip(starts[single], ends[single], strict=True)])
        pool = np.concatenate([self.pool, *extra])
        extra_ends = len(self.pool) + np.cumsum([0, *map(len, extra)])
        pool_starts, pool_ends = np.concatenate([self.starts[at], extra_ends[:-1]]), np.concatenate([self.ends[at], extra_ends[1:]])
        entry = np.empty(len(starts), dtype=np.int64)
        entry[shared], entry[single] = which, len(one) + np.arange(len(single))
        counts = (pool_ends - pool_starts)[entry]
        upto = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat(pool_starts[entry] - upto[:-1], counts) + np.arange(upto[-1])
        return pool[places], upto[np.searchsorted(cuts, offsets)]

    def _known(self, raw: bytes, key: np.ndarray, check: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the ids of each piece stand in ``pool``; new pieces are encoded together."""
        if len(self.keys) + len(key) > REMEMBERED:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        new = self.keys[at] != key if len(self.keys) else np.ones(len(key), dtype=bool)
        if len(self.keys) and np.any(self.checks[at[~new]] != check[~new]):  # another piece has the hash
            self._forget()
            return self._known(raw, key, check, low, high)
        if new.any():
            low, high = low[new], high[new]
            ids = np.array(self.encode(b"".join([raw[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]).decode("utf-8", "replace")), dtype="<u4")
            ends = len(self.pool) + np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum(high - low)) + 1
            starts = np.concatenate([[len(self.pool)], ends[:-1]])
            keys = np.concatenate([self.keys, key[new]])
            order = np.argsort(keys)
            self.keys, self.checks = keys[order], np.concatenate([self.checks, check[new]])[order]
            self.starts, self.ends = np.concatenate([self.starts, starts])[order], np.concatenate([self.ends, ends])[order]
            self.pool = np.concatenate([self.pool, ids])
        return np.searchsorted(self.keys, key)

    def _forget(self) -> None:
        self.keys = self.checks = np.zeros(0, dtype=np.uint64)
        self.starts = self.ends = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(0, dtype="<u4")

    def _whole(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        each = self._each([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        return np.concatenate([np.zeros(0, "<u4"), *each]), np.cumsum([0, *map(len, each)])


@lru_cache(maxsize=2)
def token_ids(path: str) -> TokenIds:
    return TokenIds(path)
