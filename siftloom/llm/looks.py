"""One consistent form for text that looks the same but differs in its characters.

``unify`` decomposes for compatibility, maps look-alike characters, drops what doesn't show, maps blanks and composes
again; with ``fold=True`` it also folds case in full. Characters whose compatibility form looks different from them
(superscripts, subscripts, circled signs, fractions) stay as they are.

Defined cases: null stays null; an empty text, or one of nothing but blanks and invisible characters, becomes the empty
text; texts of any length are processed whole; repeated values are worked on once per Arrow batch.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import partial

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..session import durable
from .chars import Table

# Letters that look the same as the Latin letters below them.
_ALIKE = (
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧον", "ABEZHIKMNOPTYXov"),  # Greek
    ("АВЕКМНОРСТУХЅІЈԚԜҮаеорсухѕіјһԁԛԝӏү", "ABEKMHOPCTYXSIJQWYaeopcyxsijhdqwly"),  # Cyrillic
    ("ՏՕսոօհց", "SOunohg"),  # Armenian
    ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEGHJKLMPRSTVWZ"),  # Cherokee
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),  # Lisu
    ("ɡꞬ", "gG"),
)
# Signs and hyphens of other blocks, each with the plain one.
_SIGNS = (("‐‑‒–−⁃˗", "-" * 7), ("∶ː", "::"), ("∕⁄", "//"), ("∗", "*"), ("⋅∙・", "···"), ("‚", ","), ("ǃ", "!"), ("∣ǀ", "||"), ("∼〜", "~~"))
# Radicals of the supplement block, each with the ideograph of the same shape.
_RADICALS = (
    "⺁⺄⺅⺆⺉⺊⺋⺎⺏⺐⺒⺓⺔⺕⺖⺗⺘⺙⺛⺝⺞⺠⺡⺢⺣⺤⺥⺦⺨⺩⺪⺬⺭⺮⺯⺰⺱⺲⺶⺸⺹⺺⺻⺽⺾⺿⻀⻁⻂⻃⻄⻅⻆⻈⻉⻋⻌⻍⻎⻏⻐⻑⻒⻓⻔⻖⻗⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻫⻬⻭⻮⻯⻰⻱⻲",
    "厂乙亻冂刂卜㔾兀尣尢巳幺彑彐忄㣺扌攵旡月歺民氵氺灬爫爫丬犭王疋示礻竹糹纟罓罒羊羋耂肀聿臼艹艹艹虎衤覀西见角讠贝车辶辶辶阝钅長镸长门阝雨青韦页风飞食飠饣马骨鬼鱼鸟卤麦黄黾斉齐歯齿竜龙龜亀",
)
_SHOWS = ("<super>", "<sub>", "<circle>", "<fraction>")
# The ranges of default-ignorable code points.
IGNORED = "\xad͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￸\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
_HIDDEN = re.compile(f"[{IGNORED}\x00-\x08\x0e-\x1b\x7f-\x84\x86-\x9f]+")
_BLANKS = re.compile(r"[\s⠀]+")
_PLAIN = re.compile(r"[\x20-\x7e、。一-鿿]*")


def _kept() -> tuple[re.Pattern[str], dict[int, str]]:
    """What matches the characters that stay, and one step of decomposition for those made of such characters."""
    made = {chr(c): d.split() for c in range(0x110000) if (d := unicodedata.decomposition(chr(c)))}
    stay = {c for c, d in made.items() if d[0] in _SHOWS}
    within = {c: "".join(chr(int(x, 16)) for x in d if x[0] != "<") for c, d in made.items() if c not in stay}
    return re.compile("([" + "".join(map(re.escape, sorted(stay))) + "]+)"), {ord(c): w for c, w in within.items() if stay & set(w)}


_KEPT: list[tuple[re.Pattern[str], dict[int, str]]] = []
ALIKE = {ord(a): b for xs, ys in (*_ALIKE, *_SIGNS, _RADICALS) for a, b in zip(xs, ys, strict=True)}


def unify_one(s: str, fold: bool = True) -> str:
    """The form of one text."""
    if not _PLAIN.fullmatch(s):
        if not _KEPT:
            _KEPT.append(_kept())
        stay, within = _KEPT[0]
        parts = stay.split(_HIDDEN.sub("", s).translate(within))
        s = "".join(p if k % 2 else unicodedata.normalize("NFKD", p).translate(ALIKE) for k, p in enumerate(parts))
        s = unicodedata.normalize("NFC", _HIDDEN.sub("", s))
    s = _BLANKS.sub(" ", s).strip(" ")
    return unicodedata.normalize("NFC", s.casefold()) if fold else s


def of_distinct(values: pd.Series, f: Callable[[list[str]], list[str]]) -> pd.Series:
    """f of the distinct non-null values of the batch, given all together."""
    coded = pc.dictionary_encode(pa.Array.from_pandas(values, type=pa.string()))
    return pa.array(f(coded.dictionary.to_pylist()), pa.string()).take(coded.indices).to_pandas()


_TABLES = {fold: Table(partial(unify_one, fold=fold), blanks=True) for fold in (False, True)}


def unify_all(texts: list[str], fold: bool = True) -> list[str]:
    """The form of each text."""
    return _TABLES[fold].texts(texts)


def unify(text: Column, fold: bool = True) -> Column:
    """The consistent form of a string column."""

    @F.pandas_udf(StringType())
    def form(values: pd.Series) -> pd.Series:
        return of_distinct(values, lambda texts: unify_all(texts, fold))

    return form(text)


def formed(rows: DataFrame) -> DataFrame:
    """Distinct (tbl, id, title, form) of rows (tbl, id, title), each distinct title worked on once. Kept in the shared folder."""
    titles = rows.where("id IS NOT NULL AND title IS NOT NULL").select("tbl", "id", "title").distinct()
    # Counted, so that the forms are worked out after titles of many rows have become one.
    forms = titles.groupBy("title").agg(F.count(F.lit(1)).alias("n")).where("n > 0").select("title", unify(F.col("title"), fold=False).alias("form"))
    return durable(titles.join(forms, "title").select("tbl", "id", "title", "form"), "titles")


def mixed_forms(titles: DataFrame) -> DataFrame:
    """(tbl, form) that more than one spelling has."""
    return titles.groupBy("tbl", "form").agg(F.min("title").alias("a"), F.max("title").alias("z")).where("a <> z").select("tbl", "form")


def look_alike_pairs(rows: DataFrame) -> DataFrame:
    """From (tbl, id, title): (tbl, id_lo, id_hi) of different ids whose titles differ but look the same.

    Forms with a single spelling drop out by a pre-aggregated count before any pair is built, so a group of exact copies,
    however large, never meets itself.
    """
    titles = formed(rows)
    own = titles.join(mixed_forms(titles), ["tbl", "form"])
    lo, hi = own.alias("lo"), own.alias("hi")
    return (
        lo.join(hi, (F.col("lo.tbl") == F.col("hi.tbl")) & (F.col("lo.form") == F.col("hi.form")) & (F.col("lo.id") < F.col("hi.id")) & (F.col("lo.title") != F.col("hi.title")))
        .select("lo.tbl", F.col("lo.id").alias("id_lo"), F.col("hi.id").alias("id_hi"))
        .distinct()
    )


def look_alike_classes(rows: DataFrame) -> DataFrame:
    """From (tbl, id, title): one row (tbl, id, class_id, spelling, spellings, ids) per id and spelling of a form that has more than one; class_id is the form's least id. No pairs are built."""
    titles = formed(rows)
    sizes = titles.join(mixed_forms(titles), ["tbl", "form"]).groupBy("tbl", "form").agg(F.min("id").alias("class_id"), F.count_distinct("title").alias("spellings"), F.count_distinct("id").alias("ids"))
    return titles.join(sizes, ["tbl", "form"]).select("tbl", "id", "class_id", F.col("title").alias("spelling"), "spellings", "ids")
