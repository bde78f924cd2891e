"""Local user paths in JSON, rewritten the same way wherever they stand."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from hashlib import md5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A drive, its folder of users and one of them, and the default workspace; backslashes may be escaped several times.
USER_ROOT = re.compile(r"([A-Za-z]:)(\\+)Users\\+([^\\/:*?\"<>|\s]+)", re.IGNORECASE)
WORKSPACE = re.compile(r"workspaces(\\{1,4})default(?=\1|[\"'\s]|$)")


def _chosen(names: Sequence[str], *seed: str) -> str:
    return names[int(md5("|".join(seed).encode()).hexdigest()[:8], 16) % len(names)]


def _walk(value, change: Callable[[str], str]):
    """A JSON value with every string changed; keys stay."""
    if isinstance(value, str):
        return change(value)
    if isinstance(value, dict):
        return {k: _walk(v, change) for k, v in value.items()}
    return [_walk(v, change) for v in value] if isinstance(value, list) else value


def without_local_paths(document: Column, session: Column, users: Sequence[str], workspaces: Sequence[str]) -> Column:
    """JSON with the users of its local paths, and its default workspace, renamed.

    A name depends on the session and the path alone, in small letters and with single backslashes: one path has one name in all
    documents of a session, at any depth. Drives and backslashes stay as they are. What is no JSON is rewritten as plain text, so no path
    stays behind; null documents are null, null sessions one of their own.
    """

    def changed(text: str, session: str) -> str:
        def user(found: re.Match) -> str:
            drive, dash, name = found.groups()
            return f"{drive}{dash}Users{dash}{_chosen(users, session, drive.lower(), name.lower())}"

        return WORKSPACE.sub(lambda found: f"workspaces{found[1]}{_chosen(workspaces, session)}", USER_ROOT.sub(user, text))

    @F.pandas_udf(T.StringType())
    def rewrite(documents: pd.Series, sessions: pd.Series) -> pd.Series:
        out = []
        for raw, session in zip(documents, sessions, strict=True):
            if raw is None:
                out.append(None)
                continue
            change = lambda text, s=session or "": changed(text, s)
            try:
                out.append(json.dumps(_walk(json.loads(raw), change), ensure_ascii=False))
            except ValueError:
                out.append(change(raw))
        return pd.Series(out)

    return rewrite(document, session.cast("string"))
