"""Language by compression: the language whose raw text shortens a document most.

Each language's dictionary is plain sample text.  Texts are reduced to lower-case letters and
spaces, compressed with every dictionary, and go to the language with the smallest result; where
the runner-up comes close, the answer is marked narrow and can be rejected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizops.llm.compression import compressor, dictionary, even_sample, held_out, label_sizes, map_texts, piece

UNKNOWN = "und"
NARROW = 0.01
_LETTER = regex.compile(r"\p{L}")
#: ASCII bytes other than letters become spaces; other bytes belong to letters or rare signs.
_LETTERS_ONLY = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))


def reduced(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS_ONLY)


@dataclass(frozen=True)
class LanguageModel:
    """One dictionary for each language, the commonest first (it wins ties)."""

    languages: tuple[str, ...]
    contents: tuple[bytes, ...]
    level: int

    def scorer(self, narrow: float, reject: bool):
        tools = [compressor(c, self.level, trained=False) for c in self.contents]

        def score(texts: pa.Array) -> list[pa.Array]:
            names, scores, close = [], [], []
            for t in texts:
                t = t.as_py()
                if not t or not tools or not _LETTER.search(t):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    close.append(False)
                    continue
                data = reduced(t)
                sizes = np.array([len(c.compress(data)) for c in tools], float)
                best = int(sizes.argmin())
                second = np.delete(sizes, best).min() if len(sizes) > 1 else 2 * sizes[best]
                margin = (second - sizes[best]) / second
                close.append(bool(margin < narrow))
                names.append(UNKNOWN if reject and margin < narrow else self.languages[best])
                scores.append(float(1 / (1 + np.exp(-min(40.0, 50 * margin)))))
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(close, pa.bool_())]

        return score


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        per_language: int = 500, excerpt: int = 2000, size: int = 409_600, level: int = 3,
        most: int = 200) -> LanguageModel:
    """Fit on a bounded sample: about ``per_language`` texts of every language among the rows that
    are not held out, ``excerpt`` characters from a hashed place in each (prediction takes whole
    texts).  Of more than ``most`` different values in the language column the commonest are learned.

    Rows without language or text are left out, repeated rows count once.  The model holds ``size``
    bytes a language at most.  Without any row the model knows no language and answers ``und``.
    """
    known = docs.where(~held_out(id_col)).where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text")
    )
    counts = label_sizes(known, "_lang", most)
    rows = even_sample(known, "_lang", ["_id", "_text"], per_language, counts).select(
        "_lang", piece("_text", "language", excerpt).alias("t"), "h"
    ).collect()
    texts = {name: [] for name in sorted(counts, key=lambda x: (-counts[x], x))}
    for r in sorted(rows, key=lambda r: r["h"]):
        texts[r["_lang"]].append(reduced(r["t"]))
    return LanguageModel(tuple(texts), tuple(dictionary(v, size, level, trained=False) for v in texts.values()), level)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text: str = "text",
            narrow: float = NARROW, reject: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Id, ``keep`` columns, held_out, lang_pred, score (0 to 1) and ``narrow`` for every row.

    ``und`` with score 0 stands for null texts and texts without a letter and, with ``reject``,
    for those whose best size is within the share ``narrow`` of the second.  Equal sizes go to the
    commoner language.  Repeated rows get equal answers.
    """
    found = map_texts(docs, text, [F.col(id_col), *map(F.col, keep)], "lang_pred string, score double, narrow boolean",
                      lambda: model.scorer(narrow, reject))
    return found.select(id_col, *keep, held_out(id_col).alias("held_out"), "lang_pred", "score", "narrow")
