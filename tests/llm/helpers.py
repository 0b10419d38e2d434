from __future__ import annotations

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Texts that are odd in one way each; null, empty, blanks only, repeated, very long words and texts.
ODD = [
    None, "", " ", "\n\n \t\n", "a", "  a  b ", "a\n \nb", "don't stop, it's 3am!!", "x" * 5000, "ab " * 3000, "naïve café ﬁ ①② 漢字かな 한국",
    "a\x1c b\x1f\x85 c\xa0d\u2003\u2009e\u3000f", "<|endoftext|> ~ \x00 ~~ a~b", "A\u0301 e\u0301 Σας ΣΑΣ İ", "🙂🙂 👩‍👩‍👧 flag 🇩🇪", "a\r\n\r\nb \u200b c", "1234567 12,345.67 #*$%&|<>",
    "ab " * 3000,
]


def odd_documents(spark):
    """Rows with null ids, repeated rows, and columns whose names clash with those of the operators."""
    rows = [(i * 7, t, "en", "s", 1, "clash", 5) for i, t in enumerate(ODD)] + [(None, "no id here at all", None, None, None, None, None), (7, "", "en", "s", 0, "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, label int")


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
