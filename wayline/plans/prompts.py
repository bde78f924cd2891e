"""Queries over system prompts: customers are sessions, their segments the skills they call."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayline.functions import prompts
from wayline.plans.catalog import query
from wayline.session import table



@query("""
WITH c AS (SELECT *, c_mktsegment IN ('BUILDING', 'MACHINERY') AS skilled, c_nationkey < 10 AS recalled, c_nationkey > 20 AS told FROM customer)
SELECT c_custkey,
  'before ' || c_name || chr(10) || chr(10) || '# Agent Identity' || chr(10) || 'I am ' || c_name
  || CASE WHEN recalled THEN chr(10) || chr(10) || '地图（THE MAP） go' ELSE '' END || CASE WHEN told THEN chr(10) || chr(10) || '你的对话会被持久记录 yes' ELSE '' END
  || CASE WHEN skilled THEN chr(10) || chr(10) || '<agent-skills>' || chr(10) || CASE WHEN c_mktsegment = 'MACHINERY' THEN chr(10) ELSE '' END || '<skill>' || chr(10) || '<name> ' || c_mktsegment || ' </name>' || chr(10) || c_mktsegment || ' it' || chr(10) || '</skill>' || chr(10)
      || CASE WHEN c_mktsegment = 'BUILDING' THEN chr(10) ELSE '' END || '</agent-skills>' ELSE '' END AS text,
  'AGENTS.md' || CASE WHEN recalled THEN '' ELSE ',THE MAP' END || CASE WHEN told THEN '' ELSE ',Conversation Persistence' END || CASE WHEN skilled THEN '' ELSE ',agent-skills' END AS dropped,
  CASE WHEN skilled THEN c_mktsegment ELSE '' END AS kept_skills, CASE WHEN c_mktsegment = 'BUILDING' THEN 'MACHINERY' WHEN c_mktsegment = 'MACHINERY' THEN 'BUILDING' ELSE 'BUILDING,MACHINERY' END AS dropped_skills
FROM c
""")
def f46_pruned_prompts(spark, sf_dir):
    """Prompts by what each session used: skills called, history recalled, headlines told."""
    skill = lambda n: f"<skill>\n<name> {n} </name>\n<dir>/home/x</dir>\n{n} it\n</skill>\n"
    text = F.concat(
        F.lit("before "), "c_name", F.lit("\n# Agent Identity\nI am "), "c_name", F.lit("\n# AGENTS.md\n## rules\nmany\n地图（THE MAP） go\n你的对话会被持久记录 yes\n\n<agent-skills>\n"),
        F.lit(skill("BUILDING") + skill("MACHINERY") + "</agent-skills>\nlost"),
    )
    needs = {"THE MAP": F.col("c_nationkey") < 10, "Conversation Persistence": F.col("c_nationkey") > 20}
    shown = prompts.pruned(text, F.array("c_mktsegment"), needs)
    rows = table(spark, sf_dir, "customer").select("c_custkey", shown.alias("p"))
    listed = lambda name: F.array_join(f"p.{name}", ",")
    return rows.select("c_custkey", "p.text", listed("dropped_sections").alias("dropped"), listed("kept_skills").alias("kept_skills"), listed("dropped_skills").alias("dropped_skills"))
