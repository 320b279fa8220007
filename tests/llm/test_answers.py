from __future__ import annotations

import random

import pytest

from siftloom.llm.looks import unify_one
from siftloom.llm.pairs import broken_pairs, copies_prompt, declines, differs, is_empty, language, lcs, tokens
from siftloom.llm.truncation import truncated

ENDS = ["总线被占用就会冲突", "旧数据不会混进来", "只要线缆松动就会越界", "量产测试能覆盖到"]
HEADS = ["当计数器回绕时，", "从波形上看，", "为了稳妥，", "先看时间戳，再看帧头，"]


def _corpus(rng, n, stop="。"):
    return ["".join(rng.choice(HEADS) + rng.choice(ENDS) + "。" for _ in range(rng.randint(2, 4)))[:-1] + stop for _ in range(n)]


def _cut(spark, rows):
    df = spark.createDataFrame(rows, "id STRING, grp STRING, text STRING")
    return {r["id"] for r in truncated(df, spark.createDataFrame([("怎样缩小范围",)], "text STRING")).where("cut").collect()}


def test_truncated(spark):
    rng = random.Random(1)
    whole = [(f"w{k}", "a", t) for k, t in enumerate(_corpus(rng, 60))] + [(f"h{k}", "habit", t) for k, t in enumerate(_corpus(rng, 30, ""))]
    base = _corpus(rng, 1)[0]
    cut = {"c1": base + "当计数器回", "c2": base + "为了稳妥，量产测", "c3": base + "只要线缆松", "c4": base + "从波形上看，旧数据不会…（余下略）", "c5": base + "当计数�", "c6": base + "```c\nint a", "c7": base + "看（例如", "c8": base + "先看时间戳，", "c9": base + "\n- 先看时间", "d1": base + "总线被占用 [更多]"}
    fine = {"f1": base + "\n- 先看帧头", "f2": base + "```c\nint a;\n```", "f3": base + "（展开全文的部分见上）", "f4": base + "！", "f5": "怎样缩小范围", "f6": None, "f7": " 　", "f8": "N/A", "f9": "TODO", "g1": base + "  \n"}
    list_items = [(f"l{k}", "a", t + "\n- 先看帧头\n- 先看时间戳\n") for k, t in enumerate(_corpus(rng, 30))]
    got = _cut(spark, whole + list_items + [(k, "a", v) for k, v in {**cut, **fine}.items()] + [("hc", "habit", base + "当计数器回"), ("nostop", "a", base[:-1])])
    assert got == {*cut, "hc", "nostop"}


def test_truncated_empty_and_long(spark):
    assert _cut(spark, []) == set()
    assert _cut(spark, [("a", "g", "好的。" * 100_000), ("b", "g", " " * 300_000 + "好的。")]) == set()


def test_lcs_as_dynamic_program():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 70))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
            row = new
        assert lcs(a, b) == row[-1]


@pytest.mark.parametrize(("text", "want"), [(None, True), ("", True), (" ​", True), ("……", True), ("（空）", True), ("n/a", True), ("待补充。", True), ("无法", False), ("DMA", False)])
def test_is_empty(text, want):
    assert is_empty(text) is want


def test_refusals_and_their_likes():
    t = lambda s: tokens(unify_one(s, fold=False))
    assert all(declines(t(s)) for s in ("抱歉，我无法回答这个问题。感谢理解。", "我没有办法给出I2C触发源的具体答案，请谅解。", "由于内容限制，DMA的部分暂不作答。", "I'm sorry, but I cannot help with this question."))
    assert not any(declines(t(s)) for s in ("抱歉的提示音由DMA空闲检测触发，从机无法应答时要先释放总线，再重新发起起始信号。", "不能直接在中断里等待，否则高优先级任务无法运行。", "", "无"))


def test_refusals_of_any_length():
    t = lambda s: tokens(unify_one(s, fold=False))
    padding = "另外再补充几句与本题关系不大的背景说明，供您在整理资料时参考使用，"
    assert declines(t("抱歉，我无法回答这个问题。" + padding * 8))
    assert declines(t(padding * 8 + "抱歉，我无法回答这个问题。"))
    # The words of a refusal, spread over a long answer, are none.
    spread = "".join(w + padding[3 * k % 20 : 3 * k % 20 + 9] for k, w in enumerate("抱歉我无法回答这个问题"))
    assert not declines(t(spread * 3)) and not declines([])


def test_short_copies():
    t = lambda s: tokens(unify_one(s, fold=False))
    assert copies_prompt(t("看门狗"), t("看门狗。")) and copies_prompt(t("栈"), t("栈"))
    assert not copies_prompt(t("栈"), t("堆")) and not copies_prompt([], [])


def test_an_open_bracket_of_an_earlier_line(spark):
    rows = [("open", "g", "总线被占用（例如线缆松动。\n只要线缆松动就会越界。"), ("closed", "g", "总线被占用（例如线缆松动）。\n1) 只要线缆松动就会越界。")]
    assert _cut(spark, rows) == {"open"}


def test_copies():
    t = lambda s: tokens(unify_one(s, fold=False))
    p = "可拆卸水质浮标的以太网从机模式批量中断丢失，如何估算余量？"
    assert all(copies_prompt(t(p), t(x)) for x in (p, f"题目是：{p}", p + p, f"关于“{p}”这个问题"))
    assert not any(copies_prompt(t(p), t(x)) for x in (p + "误区是只分段映射优先级上限，忘了总线被占用。", "先看以太网从机模式", "", "以太网"))


def test_languages():
    lang = lambda s: language(unify_one(s, fold=False))
    zh, en = lang("如何估算余量并解释原因"), lang("How is the margin of the bus to be measured?")
    assert (zh, en) == ("zh", "en")
    assert lang("先看 `a_b`，再读 errata note，最后用 logic analyzer 抓 setup/hold time。") == "zh"
    assert lang("Ｈow іs the mаrgin of the bus measured?") == "en"
    assert [lang(x) for x in ("タスクの優先度を下げて、もう一度測定します。", "Der Stapel wird zuerst geprüft und danach mit der Uhr verglichen.", "Проверьте буфер")] == ["ja", "de", "ru"]
    assert lang("DMA") is None and not differs("zh", None) and not differs("en", "latin") and differs("zh", "ja") and differs("en", "de")


def test_broken_pairs(spark):
    ask = "如何估算以太网从机模式的余量并解释硬件原因？"
    rows = [
        ("ok", ask, "先看计数器。", "再看帧头，最后确认次数。"), ("two", ask, None, "抱歉，我无法回答这个问题。"), ("copy", ask, ask, "再看帧头，最后确认次数。"), ("lang", ask, "Check the counter and then the header of the frame.", "好的。"),
        ("null", None, "先看计数器。", "好的。"), (None, ask, None, None), ("ok", ask, "先看计数器。", "再看帧头，最后确认次数。"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "id STRING, title STRING, answer_short STRING, answer_detail STRING, defect STRING")
    assert {tuple(r) for r in broken_pairs(df).collect()} == {("two", "empty"), ("two", "refusal"), ("copy", "copy"), ("lang", "language")}
    assert broken_pairs(df.limit(0)).count() == 0
