import random

import duckdb
import pytest
from pyspark.sql import functions as F

from wayline.functions.text import Noise
from wayline.operators import bodies
from wayline.plans import texts
from wayline.plans.catalog import ORACLES

NOISE = Noise(words=("menu",), pattern="^[0-9]+$", short_pattern="^ad")
KEEP, FOCUS, KEYWORDS, LIMIT = ("must",), "nation", ("play",), 30


def is_noise(line):
    return line == "menu" or line.isdigit() or (line.startswith("ad") and len(line) < 40)


def score(line):
    grams = [FOCUS[i : i + 3] for i in range(len(FOCUS) - 2)]
    return 4 if "must" in line else 3 if FOCUS in line or any(g in line for g in grams) else 2 if "play" in line else 1 if len(line) >= 6 else 0


def candidates(body):
    return list(dict.fromkeys(x for x in (raw.strip() for raw in body.splitlines()) if x and not is_noise(x)))


def filled(lines):
    """The text that keeps every forced line and, of the others, as much as fits, the best first."""
    rank = sorted(range(len(lines)), key=lambda i: (-min(score(lines[i]), 4), i))
    chosen, left, cut = {i: lines[i] for i in rank if score(lines[i]) == 4}, LIMIT, False
    left -= sum(len(x) + 1 for x in chosen.values())
    for i in rank:
        if i in chosen:
            continue
        if len(lines[i]) + 1 > left:
            cut = True
            if left > 0:
                chosen[i] = lines[i][:left]
            break
        chosen[i] = lines[i]
        left -= len(lines[i]) + 1
    text = "\n".join(chosen[i] for i in sorted(chosen))
    return text, len(chosen), cut or len(text) > LIMIT


def view(body, picked):
    lines = [x for x in (raw.strip() for raw in body.splitlines()) if x]
    wanted = [x.strip() for x in picked or [] if x and x.strip()]
    if wanted and all(x in lines for x in wanted):
        wanted += [x for x in candidates(body) if score(x) == 4]
        out = filled(candidates("\n".join(sorted(set(wanted), key=lines.index))))
        source = "refined"
    else:
        out, source = filled(candidates(body)), "rules"
    return out[0], out[1], max(len(candidates(body)) - out[1], 0), out[2], source


def shown(spark, rows):
    frame = spark.createDataFrame(rows, "body string, picked array<string>")
    return [tuple(r.v) for r in frame.select(bodies.view(F.col("body"), F.col("picked"), NOISE, KEEP, F.lit(FOCUS), KEYWORDS, LIMIT).alias("v")).collect()]


BODY = " first line\nmenu\nplay now\n12\nyou must go\nlast line of all\nplay now"


@pytest.mark.parametrize(
    ("picked", "want"),
    [
        (["last line of all", "first line"], ("first line\nyou must go\nlast li", 3, 1, True, "refined")),
        ([" play now "], ("play now\nyou must go", 2, 2, False, "refined")),
        (["menu"], ("you must go", 1, 3, False, "refined")),
        (["first line", "not there"], ("first lin\nplay now\nyou must go", 3, 1, True, "rules")),
        ([" ", None], ("first lin\nplay now\nyou must go", 3, 1, True, "rules")),
        ([], ("first lin\nplay now\nyou must go", 3, 1, True, "rules")),
        (None, ("first lin\nplay now\nyou must go", 3, 1, True, "rules")),
    ],
)
def test_picked_lines(spark, picked, want):
    assert view(BODY, picked) == want
    assert shown(spark, [(BODY, picked)]) == [want]


def test_any_page_as_by_brute_force(spark):
    pick = random.Random(4)
    line = lambda: pick.choice(["", " ", "menu", "77", "ad x", "must x", "playing", "tion", "abc", "abcdefg", "long line " + "y" * pick.randrange(20)])
    rows = []
    for _ in range(150):
        lines = [line() for _ in range(pick.randrange(8))]
        rows.append(("\n".join(lines), pick.choice([None, pick.sample(lines, pick.randrange(len(lines) + 1)), [*lines, "gone"]])))
    assert shown(spark, rows) == [view(*row) for row in rows]


def test_nothing_and_very_much(spark):
    assert shown(spark, [("", ["x"]), (" \n ", None)]) == [("", 0, 0, False, "rules")] * 2
    many = "\n".join(f"line {i}" for i in range(20_000))
    assert shown(spark, [(many, None)]) == [("line 0\nline 1\nline 2\nline 3\nli", 5, 19_995, True, "rules")]


@pytest.mark.parametrize("name", ["t1_digest", "t2_refined_view"])
def test_last_lines_about_the_limit_as_by_sql(spark, tmp_path, name):
    """A last line that fits without its end is whole, one that fits neither is cut, and one behind it is lost."""
    page = lambda *sizes: "\n".join(chr(97 + k) * (n - 3) + " an" for k, n in enumerate(sizes))
    pages = [page(*x) for x in ([399], [400], [401], [200, 198], [200, 199], [200, 200], [200, 199, 9], [200, 198, 9], [399, 9], [400, 9])]
    pages += ["http://x/\n" + page(n) for n in (389, 390, 391)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, lang) for lang, first in (("en", 0), ("de", 100)) for i, t in enumerate(pages, first)], "doc_id long, text string, lang string").coalesce(1).write.parquet(path)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(map(tuple, getattr(texts, name)(spark, str(tmp_path)).collect())) == sorted(duck.execute(ORACLES[name]).fetchall())
