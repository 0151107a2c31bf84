"""Very long runs of white space, which the fast tokeniser's pattern cannot take."""

from __future__ import annotations

import re

#: characters from which on a run goes in by itself; any number gives the same ids
LONG = 10_000

# White space as the pattern has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def encode_ordinary(model, text: str, long: int = LONG) -> list[int]:
    """Ids that ``model.encode_ordinary`` gives, for texts of any kind.

    The pattern goes back over white space one character at a time and its stack
    ends at about a million. It makes one piece of a run, without the last
    character where something follows; so the run is cut there, and its piece is
    given to the vocabulary as it is.
    """
    if len(text) < long:
        return model.encode_ordinary(text)
    out, at = [], 0
    for run in re.finditer(f"[{WHITE}]{{{long},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += model.encode_ordinary(text[at : run.start()])
        if end > run.start():
            out += model._encode_single_piece(text[run.start() : end].encode())
        at = end
    return out + model.encode_ordinary(text[at:])
