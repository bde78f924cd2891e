import pytest
from pyspark.sql import functions as F

from wayline.functions import prompts

USED = "text string, skills array<string>, recalled boolean"


def pruned(spark, text, skills=(), recalled=False):
    frame = spark.createDataFrame([(text, None if skills is None else list(skills), recalled)], USED)
    row = frame.select(prompts.pruned(F.col("text"), F.col("skills"), {"THE MAP": F.col("recalled"), "长期记忆": F.lit(None).cast("boolean")}).alias("p")).first().p
    return row.text, row.dropped_sections, row.kept_skills, row.dropped_skills


def cut(spark, text):
    rows = spark.createDataFrame([(text,)], "text string").select(prompts.sections(F.col("text")).alias("s")).first().s
    return [(s.kind, s.title, s.content) for s in rows]


def skill(name, more=""):
    return f"<skill>\n<name> {name} </name>\n<dir>C:\\x</dir>  \n{more}does {name}\n</skill>"


PROMPT = f"hello\n# AGENTS.md\n## Inner\n### Deeper\nrules\n地图（THE MAP） here\n# 长期记忆  \nlong\n### Directories\n a \n<agent-skills>\nlist\n{skill('one')}\n\n\n{skill('two')}\n</agent-skills>\ngone\n=============\ninfo"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", []),
        (None, []),
        ("  ", [("unknown", "", "  ")]),
        ("plain\ntext", [("unknown", "", "plain\ntext")]),
        (" \n# SOUL.md\nx", [("framework", "SOUL.md", "# SOUL.md\nx")]),
        ("a\n# SOUL.mdx\n# Agent Identity\nI", [("unknown", "", "a\n# SOUL.mdx\n"), ("identity", "Agent Identity", "# Agent Identity\nI")]),
        ("<agent-skills>\nnever closed", [("constraint", "agent-skills", "<agent-skills>\nnever closed")]),
        ("<agent-skills>\n# SOUL.md\nx</agent-skills> y", [("constraint", "agent-skills", "<agent-skills>\n# SOUL.md\nx</agent-skills>"), ("framework", "SOUL.md", "# SOUL.md\nx</agent-skills> y")]),
    ],
)
def test_sections(spark, text, want):
    assert cut(spark, text) == want


def test_sections_in_order(spark):
    assert [s[1] for s in cut(spark, PROMPT)] == ["", "AGENTS.md", "THE MAP", "长期记忆", "Directories", "agent-skills", "Framework Info"]


def test_what_stays(spark):
    one = "<skill>\n<name> one </name>\ndoes one\n</skill>"
    assert pruned(spark, PROMPT, ["one", "three"], True) == (f"hello\n\n地图（THE MAP） here\n\n### Directories\n a\n\n<agent-skills>\nlist\n{one}\n\n</agent-skills>", ["AGENTS.md", "长期记忆", "Framework Info"], ["one"], ["two"])
    assert pruned(spark, PROMPT, None, None) == ("hello\n\n### Directories\n a", ["AGENTS.md", "THE MAP", "长期记忆", "agent-skills", "Framework Info"], [], ["one", "two"])
    assert pruned(spark, "") == pruned(spark, None) == ("", [], [], [])


def test_every_part_is_worked_out_once(spark):
    """The plan names the cut into sections, the cut into skills and each beginning once, however many results ask for them."""
    shown = prompts.pruned(F.col("text"), F.col("skills"), {"THE MAP": F.col("recalled")})
    frame = spark.createDataFrame([("x", ["one"], True)], USED).select(shown.alias("p")).select("p.text", "p.dropped_sections", "p.kept_skills", "p.dropped_skills")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?=<skill>)") == 1 and plan.count("\\A# PROFILE") == 1
