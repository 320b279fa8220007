"""Keyword hits, scores and signals of a record's text and host."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

from .text import match_key
from .web import host_of, in_any_domain, in_domain


@dataclass(frozen=True)
class Rules:
    """Word lists and weights; ``load`` reads them from a JSON configuration."""

    # The words that are looked for.
    interview: Sequence[str] = (
        "面经", "面试题", "面试", "一面", "二面", "三面", "技术面", "面试官",
        "八股", "高频", "校招", "社招", "实习面试", "笔试题", "问了", "interview",
    )
    scope: Sequence[str] = (
        "嵌入式", "embedded", "linux", "驱动", "driver", "内核", "stm32", "mcu", "arm", "rtos", "freertos",
        "c语言", "c++", "操作系统", "计算机网络", "socket", "tcp", "udp", "spi", "i2c", "uart",
        "物联网", "mqtt", "机器人", "ros", "音视频", "camera", "v4l2", "ffmpeg", "嵌入式ai", "端侧推理",
    )
    reference: Sequence[str] = (
        "官方文档", "documentation", "api reference", "reference guide", "getting started",
        "developer documentation", "产品主页", "datasheet", "manual",
    )
    excluded: Sequence[str] = ("汽车电子", "车载", "autosar", "fpga", "工业控制", "plc", "功能安全")
    boosts: dict[str, int] = field(default_factory=dict)
    reference_domains: Sequence[str] = ()
    least: int = 25

    @classmethod
    def load(cls, path: str) -> Rules:
        with open(path, encoding="utf-8") as f:
            c = json.load(f)
        lists = {k: tuple(c.get(f"{k}_keywords", ())) for k in ("interview", "scope", "reference", "excluded")}
        return cls(**lists, boosts=dict(c.get("priority_domains", {})), reference_domains=tuple(c.get("reference_domains", ())), least=int(c.get("minimum_interview_score", 25)))


def keyword_hits(text: Column, words: Sequence[str]) -> Column:
    """The words of the list, in its order, that stand anywhere in the text, whatever their case."""
    low = F.lower(text)
    return F.filter(F.array(*(F.lit(w) for w in words)).cast("array<string>"), lambda w: F.contains(low, F.lower(w)))


def any_hit(text: Column, words: Sequence[str]) -> Column:
    return F.size(keyword_hits(text, words)) > 0


def domain_boost(host: Column, boosts: dict[str, int]) -> Column:
    """The largest boost of the domains that the host is in, 0 at least."""
    return F.greatest(F.lit(0), F.lit(0), *(F.when(in_domain(host, d.lower()), F.lit(int(b))).otherwise(0) for d, b in boosts.items()))


def assessed(title: Column, summary: Column, url: Column, rules: Rules) -> Column:
    """struct<score, kind, signals>: kind is excluded, interview or reference."""
    text = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")))
    host = host_of(url)
    hits = {k: keyword_hits(text, getattr(rules, k)) for k in ("interview", "scope", "reference", "excluded")}
    n = {k: F.size(v) for k, v in hits.items()}
    official = F.when(in_any_domain(host, [d.lower() for d in rules.reference_domains]), 35).otherwise(0)
    score = (domain_boost(host, rules.boosts) + n["interview"] * 12 + F.least(n["scope"], F.lit(5)) * 4 - n["reference"] * 10 - official).cast("int")
    kind = F.when(n["excluded"] > 0, "excluded").when((n["interview"] > 0) & (n["scope"] > 0) & (score >= rules.least), "interview").otherwise("reference")
    most = {"interview": 4, "scope": 5, "reference": 3, "excluded": 3}
    marked = lambda k: lambda w: F.concat(F.lit(f"{k}:"), w)
    signals = F.concat(*(F.transform(F.slice(hits[k], 1, m), marked(k)) for k, m in most.items()))
    return F.struct(score.alias("score"), kind.alias("kind"), signals.alias("signals"))


def relevant_link(anchor: Column, url: Column, seed_text: Column, seed_is_forum: Column, rules: Rules) -> Column:
    """A link worth following: nothing excluded, and asked about within scope, or from a forum within scope, or two words of the scope."""
    text = F.concat_ws(" ", anchor, F.coalesce(F.try_url_decode(url), url))
    scope = F.size(keyword_hits(text, rules.scope))
    asked = any_hit(text, rules.interview) & ((scope > 0) | any_hit(seed_text, rules.scope))
    return ~any_hit(text, rules.excluded) & (asked | (seed_is_forum & (scope > 0)) | (scope >= 2))


def same_key(a: Column, b: Column) -> Column:
    return match_key(a) == match_key(b)
