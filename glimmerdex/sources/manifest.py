"""What an index consists of: segments in the order they were committed, and how they change.

A state is a document {"next", "segments", "folded"}. A segment is {"segment", "origin",
"kind", "path", "position", …}: the first one is the base, upserts and removals follow, and of rows with one key those
of the last segment count. Positions are given out by commits, so no two segments share
one. Every function makes a new state and leaves the old one as it is.

A named segment that is written again, as a replayed batch is, takes the place it had. When
it is already part of a base, it is left out: of every series of names that end in
numbers only the last one folded can come again, and that one is kept in `folded`.
"""

from __future__ import annotations

import re

from glimmerdex.sources.commits import Conflict

State = dict
Segment = dict


def empty() -> State:
    return {"next": 0, "segments": [], "folded": {}}


def _series(name: str) -> str:
    return re.sub(r"[0-9]+$", "", name)


def _same(a: str | None, b: str | None) -> bool:
    return a is None or b is None or a == b


def _marked(state: State, gone: list[Segment]) -> dict:
    """The last named segment of each series that is no longer listed."""
    marks = dict(state["folded"])
    for s in gone:
        if s.get("named"):
            marks[_series(s["segment"])] = {"segment": s["segment"], "origin": s.get("origin")}
    return marks


def added(state: State | None, segment: Segment) -> State:
    """The state with an upsert or a removal at the end, or in its old place."""
    state = state or empty()
    if segment.get("named"):
        for k, s in enumerate(state["segments"]):
            if s.get("named") and s["segment"] == segment["segment"] and _same(s.get("origin"), segment.get("origin")):
                again = segment | {"position": s["position"]}
                return state | {"segments": [*state["segments"][:k], again, *state["segments"][k + 1 :]]}
        mark = state["folded"].get(_series(segment["segment"]))
        if mark and mark["segment"] == segment["segment"] and _same(mark["origin"], segment.get("origin")):
            return state
    placed = segment | {"position": state["next"]}
    return state | {"next": state["next"] + 1, "segments": [*state["segments"], placed]}


def replaced(state: State | None, base: Segment) -> State:
    """The state with a new base in place of everything committed so far."""
    state = state or empty()
    placed = base | {"position": state["next"]}
    return {"next": state["next"] + 1, "segments": [placed], "folded": _marked(state, state["segments"])}


def compacted(state: State | None, base: Segment, paths: list[str]) -> State:
    """The state with a base in place of the segments it was made from, which must be the first ones still.

    A compaction that came first, a replacement, or a batch written again in the meantime leaves nothing to
    fold: the rows of this base are not the newest ones."""
    state = state or empty()
    gone, left = state["segments"][: len(paths)], state["segments"][len(paths) :]
    if [s["path"] for s in gone] != paths:
        raise Conflict("the segments that were folded have changed")
    placed = base | {"position": gone[-1]["position"] if gone else state["next"]}
    return {"next": max(state["next"], placed["position"] + 1), "segments": [placed, *left], "folded": _marked(state, gone)}


def unchanged_since(state: State | None, paths: list[str]) -> None:
    """Raises Conflict if other segments are listed than those a change was worked out from."""
    if [s["path"] for s in (state or empty())["segments"]] != paths:
        raise Conflict("segments were committed meanwhile")
