"""Helpers that the tests here import by name."""

import string

_FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_GAPS = str.maketrans("\t\n\x0b\x0c\r", "     ")


def words_of(text, fold=True):
    """Words as the operators define them; with ``fold``, A-Z are lower-cased."""
    text = (text or "").translate(_GAPS)
    return [w for w in (text.translate(_FOLD) if fold else text).split(" ") if w]
