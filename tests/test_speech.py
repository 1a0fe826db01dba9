import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodestream.functions import speech
from lodestream.operators import judges


@pytest.mark.parametrize(("n", "want"), [(0, "零"), (10, "十"), (12, "十二"), (110, "一百一十"), (105, "一百零五"), (1500, "一千五百"), (10020, "一万零二十"), (100000, "十万"), (20014, "二万零一十四"), (100000000, "一亿"), (1000000005, "十亿零五")])
def test_numbers(n, want):
    assert speech.read_integer(n) == want


SPOKEN = {
    "GPT": "GPT", "API": "A P I", "Claude": "克劳德", "OpenAI": "Open A I", "Qwen3": "千问三", "MiniMax": "Mini Max", "SOTA": "S O T A", "CUDA": "库达", "CANN": "C A N N", "DeepSeek": "Deep Seek", "GitHub": "Git Hub", "Copilot": "Co Pilot",
    "SWE-bench": "S W E bench",
}


@pytest.mark.parametrize(("text", "want"), [
    ("GPT-6 发布", "GPT六发布。"), ("增长 5-7%", "增长百分之五到七。"), ("2026年有 2 个", "二零二六年有两个。"), ("Thinker-Talker", "Thinker-Talker。"), ("约 1,500 人", "约一千五百人。"), ("见 https://x.example/a。", "见。"), ("3.5 倍", "三点五倍。"), ("", ""),
    ("API 2.5 版", "A P I 二点五版。"), ("份额30%", "份额百分之三十。"), ("Claude Code 2.0", "克劳德 Code 二点零。"), ("API 定价下降了百分之二十。", "A P I 定价下降了百分之二十。"), ("阿里发布Qwen3-Max，对标MiniMax-M3.1。", "阿里发布千问三 Max，对标Mini Max M三点一。"),
    ("Xing4.0-29B-A4B 开源", "Xing四点零二百九十亿 A四B 开源。"), ("份额从5-7%升到9%", "份额从百分之五到七升到百分之九。"), ("2026年9月22日发布，支持1500万用户。", "二零二六年九月二十二日发布，支持一千五百万用户。"),
    ("上下文1M tokens，可训练参数仅70.6万。", "上下文一百万 tokens，可训练参数仅七十点六万。"), ("在 SWE-bench 上达到 SOTA", "在 S W E bench 上达到 S O T A。"), ("英伟达 CUDA 生态与华为 CANN 竞争加剧", "英伟达库达生态与华为 C A N N 竞争加剧。"),
    ("下降了-3%，回收价 $5", "下降了负百分之三，回收价美元五。"), ("下一代模型 2 个版本、2 款芯片", "下一代模型两个版本、两款芯片。"), ("阶跃星辰 **Step 5** Preview 现身 `leaderboard`", "阶跃星辰 Step 五 Preview 现身 leaderboard。"),
    ("2024-2025 财年营收 424,911 美元", "二千零二十四到二零二五财年营收四十二万四千九百一十一美元。"), ("DeepSeek V3.2 同日开源", "Deep Seek V三点二同日开源。"), ("GitHub Copilot 免费", "Git Hub Co Pilot 免费。"), ("他说：“好”……（真的）", "他说，好，真的。"), ("25°C & 3×4", "二十五摄氏度和三乘四。"),
])
def test_speech(text, want):
    assert speech.speak(text, SPOKEN) == want


def test_dictionary():
    assert speech.speak("Qwen3 和 Qwen3.5", {"Qwen3": "千问三"}).startswith("千问三和 Qwen三点五")


def test_json_and_judges(spark):
    assert json.loads(judges.first_json('so:\n```json\n{"a": 1}\n```')) == {"a": 1} and judges.first_json("none") is None
    assert json.loads(judges.first_json("x [1, 2] y")) == [1, 2]
    rows = spark.createDataFrame([(i, 0) for i in range(60)], "k int, z int").repartition(2)

    def half(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"k": part.k.iloc[: len(part) // 2 + 1], "v": "keep"})

    got = judges.ask(rows, "k", half, "k int, v string", rounds=9)
    assert {r.k for r in got.collect()} == set(range(60)) and got.count() == 60


def test_judges_of_many_rounds(spark):
    """The plan of the answers grows by one table a round: it doubled before."""
    rows = spark.createDataFrame([(i,) for i in range(7)], "k int").repartition(1)
    got = judges.ask(rows, "k", lambda part: pd.DataFrame({"k": part.k.iloc[:1], "v": "keep"}), "k int, v string", rounds=9)
    assert got._jdf.queryExecution().analyzed().toString().count("Relation") == 7
    assert sorted(r.k for r in got.collect()) == list(range(7))


def test_summary_row(spark):
    row = spark.createDataFrame([("t", None, " ", None, ["open ai", "OpenAI", ""], [" f "])], "title string, body string, a string, b string, e array<string>, f array<string>")
    r = row.select(*[c.alias(k) for k, c in judges.summary_row(*map(F.col, ("title", "body", "a", "b", "e", "f")), {"OpenAI": ["open ai"]}).items()]).first()
    assert (r.title_zh, r.summary, r.entities, r.facts) == ("t", "t", ["OpenAI"], ["f"])
