"""Numbers that describe how a text is written, over whole texts; inputs of the quality scores."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

#: Places that the words of a text, and its runs of three bytes, are hashed to.
WORD_PLACES = RUN_PLACES = 64
#: Bytes whose runs are counted at once.
AT_ONCE = 1 << 20
COUNTS = ("log_words", "mean_word", "upper", "symbol", "digit", "end_symbol", "pipe", "bang", "caps_words", "distinct", "top_word", "repeats", "line_words", "line_repeats", "stops", "short_lines")
NAMES = (*COUNTS, *(f"word_{k}" for k in range(WORD_PLACES)), *(f"run_{k}" for k in range(RUN_PLACES)))
#: Characters that prose rarely holds.
ODD = frozenset(b"#$%&*+/<=>@[\\]^_`{|}~")
_BYTE_ODD = np.zeros(256, bool)
_BYTE_ODD[list(ODD)] = True
_UPPER_LATIN = np.zeros(256, bool)
_UPPER_LATIN[0x80:0x9F] = True  # second bytes of À..Þ behind 0xC3
_UPPER_LATIN[0x97] = False


def word_shares(counted: Counter[bytes], n: int) -> np.ndarray:
    """Roots of the shares of ``n`` words that fall on each place; a word's case doesn't count."""
    at = np.array([zlib.crc32(w.lower()) for w in counted], np.int64) % WORD_PLACES
    return np.sqrt(np.bincount(at, np.fromiter(counted.values(), float, len(counted)), WORD_PLACES) / n)


def run_shares(b: np.ndarray) -> np.ndarray:
    """Roots of the shares of a text's runs of three bytes that fall on each place."""
    out = np.zeros(RUN_PLACES)
    for a in range(0, len(b) - 2, AT_ONCE):
        c = b[a : a + AT_ONCE + 2].astype(np.uint32)
        run = c[:-2] | c[1:-1] << np.uint32(8) | c[2:] << np.uint32(16)
        out += np.bincount((run * np.uint32(0x9E3779B1)) >> np.uint32(26), minlength=RUN_PLACES)
    return np.sqrt(out / max(1, len(b) - 2))


def of_text(text: str | None) -> np.ndarray:
    """One row of ``NAMES``; zeros for an empty or null text."""
    out = np.zeros(len(NAMES))
    if not text:
        return out
    raw = text.encode()
    b = np.frombuffer(raw, np.uint8)
    words = raw.split()
    n = len(words)
    if not n:
        return out
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counted = Counter(words)
    upper = int(((b >= 65) & (b <= 90)).sum())
    upper += int((_UPPER_LATIN[b[1:]] & (b[:-1] == 0xC3)).sum())
    size = len(b)
    lasts = np.frombuffer(bytes([w[-1] for w in words]), np.uint8)
    counts = np.array(
        [
            np.log1p(n),
            np.log1p(size / n),
            upper / size,
            float(_BYTE_ODD[b].mean()),
            float(((b >= 48) & (b <= 57)).mean()),
            float(_BYTE_ODD[lasts].mean()),
            raw.count(b"|") / n,
            raw.count(b"!!") / n,
            sum(map(bytes.isupper, words)) / n,
            len(counted) / n,
            max(counted.values()) / n if n > 5 else 0.0,
            sum(map(bytes.__eq__, words, words[1:])) / n,
            np.log1p(n / max(1, len(lines))),
            1 - len(set(lines)) / max(1, len(lines)),
            float((np.isin(lasts, (46, 63))).sum() / n),
            sum(len(x) < 30 for x in lines) / max(1, len(lines)),
        ]
    )
    return np.concatenate([counts, word_shares(counted, n), run_shares(b)])
