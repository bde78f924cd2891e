"""System prompts cut into sections and kept by what a session used. Column in, Column out."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How sections begin, what kind they are, and their titles.
BOUNDARIES = (
    (r"^# Agent Identity\s*$", "identity", "Agent Identity"),
    (r"^# AGENTS\.md\s*$", "framework", "AGENTS.md"),
    (r"^# SOUL\.md\s*$", "framework", "SOUL.md"),
    (r"^# PROFILE\.md\s*$", "framework", "PROFILE.md"),
    (r"^You can only understand text content", "constraint", "Image Understanding"),
    (r"^### Directories\s*$", "constraint", "Directories"),
    (r"^你的对话会被持久记录", "constraint", "Conversation Persistence"),
    (r"^地图（THE MAP）", "constraint", "THE MAP"),
    (r"^纪律（DISCIPLINE）", "constraint", "DISCIPLINE"),
    (r"^={10,}", "framework", "Framework Info"),
    (r"^<agent-skills>", "constraint", "agent-skills"),
    (r"^# 长期记忆\s*$", "constraint", "长期记忆"),
)
SKILLS, SKILLS_END = "agent-skills", "</agent-skills>"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often use asks for it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sections(text: Column, boundaries: Sequence[tuple[str, str, str]] = BOUNDARIES) -> Column:
    """array<struct<kind,title,content>> of a prompt, in order; nothing for empty and null ones.

    A section goes on to the next beginning, skills to the end of their block, wherever it is. What comes before the first beginning is
    unknown, and left out if blank; a prompt without any is one unknown section.
    """
    whole = F.coalesce(text, F.lit(""))
    begins = F.split(whole, "(?m)(?=" + "|".join(f"(?:{p})" for p, _, _ in boundaries) + ")")
    named = lambda kind, title: F.struct(F.lit(kind).alias("kind"), F.lit(title).alias("title"))

    def head(piece: Column) -> Column:
        found = named("unknown", "")
        for pattern, kind, title in reversed(boundaries):
            found = F.when(piece.rlike(r"(?m)\A" + pattern.removeprefix("^")), named(kind, title)).otherwise(found)
        return found

    def block(rest: Column) -> Column:
        end = F.instr(rest, SKILLS_END)
        return F.when(end > 0, F.left(rest, end + len(SKILLS_END) - 1)).otherwise(rest)

    def cut(pieces: Column) -> Column:
        def section(piece: Column, place: Column) -> Column:
            rest = F.array_join(F.slice(pieces, place + 1, F.size(pieces)), "")
            content = lambda h: F.when(h["title"] == SKILLS, once(rest, block)).otherwise(piece)
            return once(head(piece), lambda h: F.struct(h["kind"].alias("kind"), h["title"].alias("title"), content(h).alias("content")))

        some = lambda s: (s["title"] != "") | (F.regexp_replace(s["content"], r"\s+", "") != "") | (F.size(pieces) == 1)
        return F.filter(F.transform(pieces, section), lambda s: (whole != "") & some(s))

    return once(begins, cut)


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def skills_kept(content: Column, called: Column) -> Column:
    """(text, kept, dropped) of a block of skills: those that were called, without the lines that tell where they lie."""
    name = lambda p: F.regexp_extract(p, r"(?s)<name>\s*(.*?)\s*</name>", 1)
    part = lambda p: once(F.when(p.rlike(r"(?s)\A<skill>.*</skill>\z"), name(p)), lambda n: F.struct(p.alias("text"), n.alias("name"), F.array_contains(called, n).alias("wanted")))

    def told(parts: Column) -> Column:
        names = lambda keep: F.transform(F.filter(parts, lambda p: p["name"].isNotNull() & (p["wanted"] if keep else ~p["wanted"])), lambda p: p["name"])
        shown = F.transform(parts, lambda p: F.when(p["name"].isNull(), p["text"]).when(p["wanted"], F.regexp_replace(p["text"], r"(?m)^<dir>.*?</dir>\s*\n?", "")).otherwise(""))
        text = _strip(F.regexp_replace(F.array_join(shown, ""), r"\n{3,}", "\n\n"))
        return once(names(True), lambda kept: F.struct(F.when(F.size(kept) > 0, text).otherwise("").alias("text"), kept.alias("kept"), names(False).alias("dropped")))

    return once(F.transform(F.split(content, r"(?s)(?=<skill>)|(?<=</skill>)"), part), told)


def pruned(text: Column, skills: Column, needs: Mapping[str, Column], boundaries: Sequence[tuple[str, str, str]] = BOUNDARIES) -> Column:
    """(text, dropped_sections, kept_skills, dropped_skills) of a prompt.

    Framework goes. A section whose title `needs` names stays only where its condition holds; null does not. Skills stay as skills_kept() has them, the
    section with them only if one does. All others stay, without blanks at their ends, an empty line between two.
    """
    called = F.coalesce(skills, F.array().cast("array<string>"))

    def judged(s: Column) -> Column:
        used = F.lit(True)
        for title, condition in needs.items():
            used = F.when(s["title"] == title, F.coalesce(condition, F.lit(False))).otherwise(used)
        is_skills = s["title"] == SKILLS
        none = F.array().cast("array<string>")
        asked = is_skills & used & (s["kind"] != "framework")

        def shown(of_skills: Column) -> Column:
            return F.struct(
                s["title"].alias("title"),
                ((s["kind"] != "framework") & used & ~(is_skills & (of_skills["text"] == ""))).alias("kept"),
                F.when(is_skills, of_skills["text"]).otherwise(_strip(s["content"])).alias("text"),
                F.when(asked, of_skills["kept"]).otherwise(none).alias("kept_skills"),
                F.when(asked, of_skills["dropped"]).otherwise(none).alias("dropped_skills"),
            )

        return once(F.when(is_skills, skills_kept(s["content"], called)), shown)

    def told(each: Column) -> Column:
        return F.struct(
            F.array_join(F.filter(F.transform(F.filter(each, lambda s: s["kept"]), lambda s: s["text"]), lambda t: t != ""), "\n\n").alias("text"),
            F.transform(F.filter(each, lambda s: ~s["kept"]), lambda s: s["title"]).alias("dropped_sections"),
            F.flatten(F.transform(each, lambda s: s["kept_skills"])).alias("kept_skills"),
            F.flatten(F.transform(each, lambda s: s["dropped_skills"])).alias("dropped_skills"),
        )

    return once(F.transform(sections(text, boundaries), judged), told)
