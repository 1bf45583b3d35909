"""Cutting texts for a byte-level vocabulary into pieces whose tokens do not depend on each other.

A token of the byte-level pattern holds white space only at its start or throughout. So one that begins
at a space or line feed after a character that is no white space never reaches back over it, and what
lies before it does not look ahead. Texts repeat their words, so the pieces are few and their tokens
can be remembered.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc

# White space other than space and line feed, and characters some tools take for it.
_OTHER_SPACES = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 ᠎​    　﻿" + "".join(
    map(chr, range(0x2000, 0x200B))
)
_RUNS = ("  ", "\n\n", " \n", "\n ")
_ODD = re.compile(f"[{_OTHER_SPACES}]")
_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def _is_odd(text: str) -> bool:
    """Whether a text holds other white space than single spaces and line feeds."""
    return any(run in text for run in _RUNS) or bool((not text.isascii() or not text.isprintable()) and _ODD.search(text))


def split_odd(text: str) -> list[str]:
    """A text with other white space stays whole; one with longer runs of spaces or line feeds is cut where a
    run begins."""
    return [text] if _ODD.search(text) else _PIECES.findall(text)


class Pieces:
    """The pieces of many texts: of the odd ones as lists, and of all others in one run, each as a number
    of a table of distinct pieces without the one space before them (see ``spelled``)."""

    def __init__(self, texts: list[str]):
        self.odd = {i: split_odd(t) for i, t in enumerate(texts) if _is_odd(t)}
        self.plain = [i for i in range(len(texts)) if i not in self.odd]
        column = pa.array([texts[i] for i in self.plain], pa.large_string())
        split = pc.split_pattern(pc.replace_substring(column, "\n", " \n"), " ")
        self.offsets = split.offsets.to_numpy()  # of each plain text, where its pieces begin
        values = split.flatten()
        coded = values.dictionary_encode()
        self.numbers = coded.indices.to_numpy()
        self.names: list[str] = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist is slow
        # the pieces with which the texts begin stand without a space before them
        self.first = values.take(pa.array(self.offsets[:-1])).to_pylist()


def spelled(part: str) -> str:
    """A piece that follows another as it stands in the text."""
    return part if part[:1] == "\n" else " " + part
