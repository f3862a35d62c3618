import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowloom.llm.plainform import LOOKALIKES, plain, plain_column, words


def brute(text):
    """Whole-text normalisation, character by character."""
    kept = []
    for c in unicodedata.normalize("NFKD", text):
        c = LOOKALIKES.get(c, c)
        if c.isspace():
            kept.append(" ")
        elif unicodedata.category(c) not in ("Cf", "Cc"):
            kept.append(c)
    return " ".join(unicodedata.normalize("NFC", "".join(kept)).split())


def test_cases():
    assert plain(None) is None
    assert plain("") == plain(" ​　") == ""
    assert plain("Ａ　ﬁne  café") == "A fine café"
    assert plain("e​́") == "é"
    assert plain("а́") == "á"  # a Cyrillic letter below a combining accent
    assert plain("각") == "각"
    assert plain("ρaуѕ") == "pays"
    same = "plain already, 好。"
    assert plain(same) == same


ALPHABET = "aeZ .,'-!?éÉ́̈  　​­﻿аеоѕοΑＡｂﬁ½中文。，𝐀𝗯\n\t"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=40))
def test_splicing_equals_whole_text_normalisation(text):
    assert plain(text) == brute(text)
    assert plain(plain(text)) == plain(text)


def test_words():
    assert words("It's 3 ｃａｔｓ, 中文a") == ["it", "s", "3", "cats", "中", "文", "a"]
    assert words(None) == words("") == words("...") == []


def test_column(spark):
    texts = [None, "", "plain text", " two  spaces", "ｆｕｌｌ", "x" * 200_000 + "​"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(plain_column(F.col("t"))).collect()] == [plain(t) for t in texts]
