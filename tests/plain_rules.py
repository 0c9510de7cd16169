"""The cleaning and token rules stated character by character, without any regular expression."""

from itertools import groupby

from tonemill.constants import PUNCTUATION, SPELLING


def is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def mask(text: str, prefix: str, replacement: str) -> str:
    """``prefix`` with at least one more visible character, up to the next space."""
    out, i = "", 0
    while i < len(text):
        end = i + len(prefix)
        if text.startswith(prefix, i) and end < len(text) and not text[end].isspace():
            while end < len(text) and not text[end].isspace():
                end += 1
            out, i = out + replacement, end
        else:
            out, i = out + text[i], i + 1
    return out


def join_pairs(text: str) -> str:
    """Drop an apostrophe between two words, unless its left word closed a pair already."""
    out, free = "", True
    for i, c in enumerate(text):
        inner = c == "'" and 0 < i < len(text) - 1 and is_word(text[i - 1]) and is_word(text[i + 1])
        if inner and free:
            free = False
            continue
        if not is_word(c):
            free = True
        out += c
    return out


def clean(text: str, profile: str) -> str:
    x = mask(mask(text.lower(), "@", "X"), "http", "http")
    if profile == "embedding":
        x = mask(x, "#", "X")
    if profile != "contextual":
        x = join_pairs("".join(" " if c in PUNCTUATION else c for c in x))
    x = "".join(c for c in x if ord(c) < 128)
    if profile != "contextual":
        runs = [(c, len(list(g))) for c, g in groupby(x)]
        x = " ".join("".join(c if n > 2 and c != "\n" else c * n for c, n in runs).split())
    return "".join(SPELLING.get(run, run) for run in
                   ("".join(g) for _, g in groupby(x, key=is_word)))


def word_tokens(text: str) -> list[str]:
    runs = ("".join(g) for word, g in groupby(text.lower(), key=is_word) if word)
    return [r for r in runs if len(r) > 1]


def wordpieces(word: str, vocab: set[str]) -> list[str]:
    if len(word) > 100:
        return ["[UNK]"]
    pieces, at = [], 0
    while at < len(word):
        ends = [e for e in range(at + 1, len(word) + 1)
                if ("##" if at else "") + word[at:e] in vocab]
        if not ends:
            return ["[UNK]"]
        pieces.append(("##" if at else "") + word[at:ends[-1]])
        at = ends[-1]
    return pieces
