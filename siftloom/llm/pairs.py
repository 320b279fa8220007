"""Defects of prompt and response pairs: empty, refusal, copy, language (truncated: see truncation).

Response tokens (Han and kana characters, words, numbers) are aligned with those of the prompt, and of refusal
templates: the containment of their two-token shingles tells which alignments are worth a look and where, the longest
common subsequence, computed bit-parallel, decides.

Defined cases: a null, blank or invisible response is empty, and so is a placeholder; an empty response has no other
defect; with a null prompt there is no copy and no language to compare; texts of any length are aligned whole; a record
gets each defect once, whichever of its responses has it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from .looks import unify_all, unify_one
from .sketches import letters_form, letters_forms
from .truncation import PLACEHOLDERS, truncated

# How answers are declined. Further words between and after these don't matter.
REFUSALS = (
    "抱歉，我无法回答这个问题",
    "对不起，这道题超出了我能提供帮助的范围，请换一个问题",
    "不好意思，我只是一个整理工具，给不了这方面的建议",
    "很遗憾，目前没有足够的资料，恕不能作答",
    "作为一个语言助手，我不便对此给出结论",
    "恕我直言，这里我帮不上忙，您可以查阅手册",
    "这个问题我不能帮忙，建议直接咨询相关人员",
    "此题涉及敏感内容，已拒绝生成答案",
    "我没有办法给出具体答案，请谅解",
    "由于内容限制，的部分暂不作答",
    "作为人工智能，我不能提供这方面的内容",
    "很抱歉，我不能协助处理这个请求",
    "I am sorry, but I cannot help with this question",
    "I'm sorry, I can't assist with that request",
    "As an AI language model, I am unable to answer this",
    "Unfortunately I cannot provide an answer to this question",
)
#: Part of a template that must stand in the response in order; further tokens that may stand between.
DECLINED, BEYOND = 0.8, 40
#: Tokens that a copy may have beyond the prompt's (a lead-in), and the part of the prompt that it must have.
LEAD, COPIED = 8, 0.6

# Function words that tell languages in Latin letters apart.
_WORDS = {
    "en": "the and is are was of to in on at by for with before after when while because so then that this it has have not more than must may can",
    "de": "der die das den dem und ist sind war nicht ein eine einen mit wird werden wenn dann danach zuerst ohne auf im zu von für als bis nach kann muss",
    "fr": "le la les des du et est sont dans une un pour pas que qui avec sur au aux après avant lorsque puis sans doit peut ne se par",
    "es": "el los las de y es son en una un para no que con por al del después antes cuando luego sin debe puede se lo",
    "pt": "o os as de e é são em uma um para não que com por ao do da depois antes quando sem deve pode se",
    "it": "il lo gli di e è sono in una un per non che con da al del della dopo prima quando poi senza deve può si",
}
_LANG = {w: [k for k, ws in _WORDS.items() if w in ws.split()] for w in {w for ws in _WORDS.values() for w in ws.split()}}
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`|\b\w*(?:_|\d)\w*\b", re.DOTALL)
_SCRIPTS = (("kana", "぀-ヿㇰ-ㇿ"), ("ko", "가-힣ᄀ-ᇿ"), ("ru", "Ѐ-ӿ"), ("ar", "؀-ۿ"), ("he", "֐-׿"), ("th", "฀-๿"), ("hi", "ऀ-ॿ"), ("el", "Ͱ-Ͽ"))
_SCRIPT = {k: re.compile(f"[{r}]") for k, r in _SCRIPTS}
_MAYBE_CODE = re.compile(r"[`_\d]")
_COMMON = re.compile(r"[\x00-\u02af\u2000-\u206f\u3000-\u303f\u4e00-\u9fff\uff00-\uffef]*")
_LETTER = re.compile(r"[^\W\d_\u4e00-\u9fff\u3400-\u4dbf]")
_HAN = re.compile(r"[一-鿿㐀-䶿]")
_LATIN = re.compile(r"[^\W\d_]+")
_TOKEN = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_぀-ヿ㐀-鿿]+")


def tokens(text: str) -> list[str]:
    """Tokens of a text in its consistent form, in one case."""
    return _TOKEN.findall(text.casefold())


def shingles(t: Sequence[str]) -> set[tuple[str, str]]:
    return set(zip(t, t[1:]))


def lcs(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence; one big-number step for each of b's items."""
    at: dict[str, int] = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for y in b:
        u = v & at.get(y, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def is_empty(response: str | None) -> bool:
    if response is None:
        return True
    s = letters_form(response)
    return not s or s in PLACEHOLDERS


_TEMPLATES: list[tuple[list[str], set[str], set[tuple[str, str]]]] = []


def _templates() -> list[tuple[list[str], set[str], set[tuple[str, str]]]]:
    if not _TEMPLATES:
        _TEMPLATES.extend((x, set(x), shingles(x)) for x in (tokens(unify_one(r, fold=False)) for r in REFUSALS))
    return _TEMPLATES


def declines(t: Sequence[str]) -> bool:
    """Whether a refusal stands somewhere in the response: most of a template in order, no more than BEYOND further tokens between.

    In a response of any length, the places where the template's shingles stand tell where to align it.
    """
    words = set(t)
    for x, own, s in _templates():
        # Tokens of the template that the response lacks can't be aligned.
        if len(own - words) > (1 - DECLINED) * len(x):
            continue
        at = [k for k in range(len(t) - 1) if (t[k], t[k + 1]) in s]
        if 2 * len({(t[k], t[k + 1]) for k in at}) < len(s):
            continue
        wide = len(x) + BEYOND
        if len(t) <= wide:
            if lcs(x, t) >= DECLINED * len(x):
                return True
            continue
        for k in at:
            near = t[max(0, k - len(x) // 4) : max(0, k - len(x) // 4) + wide]
            if 2 * len({y for y in zip(near, near[1:]) if y in s}) >= len(s) and lcs(x, near) >= DECLINED * len(x):
                return True
    return False


def copies_prompt(p: Sequence[str], t: Sequence[str]) -> bool:
    """All of the response but a lead-in stands in the prompt, and most of the prompt in the response."""
    if len(set(t).difference(p)) > LEAD:
        return False
    own = shingles(p)
    if not own:
        return bool(t) and list(p) == list(t)
    hit = [x in own for x in zip(t, t[1:])]
    new = sum(not (a or b) for a, b in zip([False, *hit], [*hit, False]))
    return new <= LEAD and 2 * sum(hit) >= max(len(hit), 1) and lcs(p, t) >= COPIED * len(p)


def language(text: str) -> str | None:
    """Of a text in its consistent form: zh, ja, a language of another script, one of _WORDS, ``latin`` when its words don't tell, or None for too little text."""
    s = _CODE.sub(" ", text) if _MAYBE_CODE.search(text) else text
    # Texts of Han characters, Latin letters and common signs need no look at the other scripts.
    n = dict.fromkeys(_SCRIPT, 0) if _COMMON.fullmatch(s) else {k: len(r.findall(s)) for k, r in _SCRIPT.items()}
    han = len(_HAN.findall(s))
    words = [w.lower() for w in _LATIN.findall(_HAN.sub(" ", s))] if _LETTER.search(s) else []
    most = max(n, key=n.__getitem__)
    if n[most] >= 3 and n[most] >= 0.15 * (han + n[most]) and n[most] >= len(words):
        return "ja" if most == "kana" else most
    if han >= 2 and han >= 0.5 * len(words):
        return "zh"
    if sum(map(len, words)) < 12:
        return None
    score = dict.fromkeys(_WORDS, 0.0)
    for w in words:
        for k in _LANG.get(w, ()):
            score[k] += 1 / len(_LANG[w])
    best = max(score, key=score.__getitem__)
    return best if score[best] >= 1 else "latin"


def differs(a: str | None, b: str | None) -> bool:
    if a is None or b is None or a == b:
        return False
    return not ("latin" in (a, b) and {a, b} <= {"latin", *_WORDS})


@F.pandas_udf(ArrayType(StringType()))
def defects_of(prompts: pd.Series, shorts: pd.Series, details: pd.Series) -> pd.Series:
    texts = sorted({t for column in (prompts, shorts, details) for t in column if t is not None})
    forms, letters = dict(zip(texts, unify_all(texts, fold=False))), dict(zip(texts, letters_forms(texts)))
    empty = {t for t, s in letters.items() if not s or s in PLACEHOLDERS}
    out = []
    for prompt, *responses in zip(prompts, shorts, details):
        found = set()
        p = tokens(forms[prompt]) if prompt is not None else []
        spoken = language(forms[prompt]) if prompt is not None else None
        for r in responses:
            if r is None or r in empty:
                found.add("empty")
                continue
            t = tokens(forms[r])
            if declines(t):
                found.add("refusal")
            elif copies_prompt(p, t):
                found.add("copy")
            if differs(spoken, language(forms[r])):
                found.add("language")
        out.append(sorted(found))
    return pd.Series(out)


def broken_pairs(rows: DataFrame) -> DataFrame:
    """From (id, title, answer_short, answer_detail): (id, defect), distinct."""
    rows = rows.where("id IS NOT NULL").select("id", "title", "answer_short", "answer_detail").distinct()
    other = rows.select("id", F.explode(defects_of("title", "answer_short", "answer_detail")).alias("defect"))
    texts = rows.select("id", F.lit("short").alias("grp"), F.col("answer_short").alias("text")).unionByName(rows.select("id", F.lit("detail").alias("grp"), F.col("answer_detail").alias("text")))
    cut = truncated(texts, rows.select(F.col("title").alias("text")).distinct()).where("cut").select("id", F.lit("truncated").alias("defect"))
    return other.unionByName(cut).distinct()
