"""Words and the marks after them are merged apart, with the ids of the whole text."""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from billscope.llm import tokens


def test_a_word_is_merged_once_whatever_marks_follow():
    own, merged = tokens.Encoder(tokens.WORDS), []
    merge = own.merge
    own.merge = lambda letters: merged.append(letters) or merge(letters)
    text = "Zebrafishy zebrafishy, zebrafishy!! zebrafishy. zebrafishy's zebrafishy'' (zebrafishy) \u00e9tang \u00c9tang; \u00e9tang--"
    plain = Tokenizer.from_file(tokens.location(tokens.WORDS))
    wanted = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert own.encode([text.encode()]) == [wanted]
    assert merged.count("zebrafishy") == 1
