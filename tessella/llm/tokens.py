"""Token identifiers of whole texts, with a bounded cache of the pieces between blanks.

The tokenizer never joins characters across a blank or a newline, so a text's identifiers are those of the
pieces between them, in order.  Each distinct piece is encoded once while it stays in the cache.
"""

from __future__ import annotations

import json
import os
import threading
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

VOCABULARY = "word_bpe_49k.json"
CACHE_ENTRIES = 300_000
CACHED_PIECE = 200
IDLE_SECONDS = 0.5  # that a worker keeps its caches for the next task
END = 1
MARKER = "<|startoftext|>"
#: Fixed value: the vocabulary's own pattern for the runs that it encodes apart.
_RUN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The byte-level alphabet: printable bytes stand for themselves, the others for characters from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
_LATIN = "\u0250"  # below it, lower case and normal form are those of single characters


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TokenIds:
    """`of(text)` gives a text's identifiers as little-endian unsigned 32-bit bytes."""

    _by_path: dict = {}
    _timer: threading.Timer | None = None

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._mark = self._model.token_to_id(MARKER)
        if self._mark is None:
            self._model.add_tokens([MARKER])
            self._mark = self._model.token_to_id(MARKER)
        self._cache: dict[str, bytes] = {"": b""}
        self._runs: dict[str, bytes] = {}
        pattern = json.loads(self._model.pre_tokenizer.__getstate__())["pretokenizers"][0]["pattern"]["Regex"]
        if pattern != _RUN.pattern:
            raise ValueError("this vocabulary splits texts by another pattern")

    @classmethod
    def open(cls, path: str | None = None) -> TokenIds:
        path = path or vocabulary_path()
        if path not in cls._by_path:
            cls._by_path[path] = cls(path)
        return cls._by_path[path]

    @classmethod
    def forget(cls) -> None:
        cls.keep()
        cls._by_path.clear()

    @classmethod
    def keep(cls) -> None:
        """Call off `forget_soon`."""
        if cls._timer:
            cls._timer.cancel()
            cls._timer = None

    @classmethod
    def forget_soon(cls, then, seconds: float = IDLE_SECONDS) -> None:
        """Forget all caches and call `then`, unless `keep` comes before.  A text in work goes on with what it has."""

        def idle():
            cls._by_path.clear()
            then()

        cls.keep()
        cls._timer = threading.Timer(seconds, idle)
        cls._timer.daemon = True
        cls._timer.start()

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Identifiers of each piece, from one call: a marker that no piece contains stands between them."""
        whole = self._model.encode(MARKER.join(pieces), add_special_tokens=False)
        ids = np.asarray(whole.ids, "<u4")
        cuts = np.flatnonzero(ids == self._mark)
        if len(cuts) != len(pieces) - 1:
            raise ValueError("the marker isn't one token")
        raw, begin, end = ids.tobytes(), np.r_[0, cuts + 1] * 4, np.r_[cuts, len(ids)] * 4
        return [raw[a:b] for a, b in zip(begin.tolist(), end.tolist())]

    def _of_missing(self, missing: list[str]) -> list[bytes]:
        """Identifiers of distinct pieces that aren't cached."""
        made: list = [None] * len(missing)
        # Plain Latin pieces fall into the tokenizer's own runs, which recur more often; others go to it whole.
        single, several, whole = {}, {}, []
        for k, p in enumerate(missing):
            if p.isalpha() and p.isascii():
                single[k] = p.lower()
            elif "<|" in p:
                made[k] = np.asarray(self._model.encode(p, add_special_tokens=False).ids, "<u4").tobytes()
            elif p.isprintable() and (p.isascii() or max(p) < _LATIN):
                several[k] = _RUN.findall(p.lower())
            else:
                whole.append(k)
        held, merge = self._runs, self._model.model.tokenize
        distinct = list(set(single.values()).union(*several.values()))
        runs = dict(zip(distinct, map(held.get, distinct)))
        fresh = [r for r, ids in runs.items() if ids is None]
        for r in fresh:
            shown = r if r.isascii() else r.encode().decode("latin-1").translate(_BYTE_LEVEL)
            runs[r] = array("I", [t.id for t in merge(shown)]).tobytes()
        for k, r in single.items():
            made[k] = runs[r]
        for k, own in several.items():
            made[k] = b"".join(map(runs.__getitem__, own))
        for at in range(0, len(whole), 4000):
            some = whole[at : at + 4000]
            for k, ids in zip(some, self._encode([missing[k] for k in some])):
                made[k] = ids
        self._hold(self._cache, missing, made)
        self._hold(held, fresh, [runs[r] for r in fresh])
        return made

    @staticmethod
    def _hold(cache: dict[str, bytes], keys: list[str], ids: list[bytes]) -> None:
        """Full caches hold what came first, and so nearly all frequent entries; later ones are for one call only."""
        if len(cache) + len(keys) <= CACHE_ENTRIES:
            cache.update((p, x) for p, x in zip(keys, ids) if len(p) <= CACHED_PIECE)

    def of_all(self, texts: list[str]) -> list[bytes]:
        """Identifiers of each text.  Only its distinct pieces become strings; the rest is arithmetic on their numbers."""
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        pieces, number = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        found = list(map(self._cache.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        for k, ids in zip(missing, self._of_missing([pieces[k] for k in missing])):
            found[k] = ids
        flat, size = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        each = size.take(number)
        upto = np.cumsum(np.r_[0, each])
        # Where each identifier stands among those of the distinct pieces.
        place = np.repeat((np.cumsum(size) - size).take(number) - upto[:-1], each)
        place += np.arange(len(place))
        raw, cuts = flat.take(place).tobytes(), (4 * upto[split.offsets.to_numpy()]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


def in_slices(texts: Iterable, size: int = 1 << 19):
    """(first row, some texts) such that a slice holds about `size` characters, or one text; a null is empty.

    Texts are taken as they are needed: a batch of them needn't become strings at once.
    """
    own, first, held = [], 0, 0
    for k, t in enumerate(texts):
        own.append(t or "")
        held += len(t or "")
        if held >= size:
            yield first, own
            own, first, held = [], k + 1, 0
    if own:
        yield first, own
