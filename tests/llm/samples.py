"""Invented prose."""


def prose(seed: int, words: int) -> str:
    """Invented words, the same for the same seed."""
    out, state = [], seed * 7919 + 17
    for _ in range(words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append("".join("bcdfghklmnprstvw"[(state >> k) % 16] + "aeiou"[(state >> (k + 3)) % 5] for k in (5, 11, 17)[: 1 + state % 3]))
    return " ".join(out)
