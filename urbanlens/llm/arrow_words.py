"""Words of whole Arrow columns, found by Arrow's own kernels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed patterns: what stands between words of ASCII letters, digits and all non-ASCII
#: characters, and between words of letters alone.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(texts: pa.Array, separators: str) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each word, its index among the distinct words, the distinct words as bytes).

    ``texts`` are UTF-8 bytes without nulls; A-Z are lower-cased first.
    Words are in text order, row by row.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(texts.view(pa.string())), separators)
    words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.greater(pc.binary_length(words), 0)   # a text may start or end with a separator
    coded = words.filter(real).dictionary_encode()
    return (rows.filter(real).to_numpy(zero_copy_only=False).astype(np.int64),
            coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.view(pa.binary()))
