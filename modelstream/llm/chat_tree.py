"""Chat formatting with shared beginnings: prefix trees of conversations, written depth-first.

A conversation is the path of its turns. Sorted by path, conversations that begin alike stand side by side, and writing each
one's turns beyond those it shares with the one before is the depth-first order of the tree. Equal conversations are one path. The
sorted paths are dealt out by ranges and cut into packs of bounded size, so a tree of any size, even one whose first turn
a third of all conversations share, is spread over many packs; a pack repeats only the turns above its first path.

A pack is one text with nodes. Each node has its span, the position of its first character on its path (its characters go on
from there), and the spans it may attend to: those of its ancestors and its own. The loss mask is the span of an assistant's text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters after which a pack ends; a longer path is a pack of its own.
PACK = 1 << 15

# What marks a turn.
HEAD, MID, END = "### ", ": ", " </turn>\n"
_TEXT = re.compile(r"\\|###|</turn>")
_ROLE = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(
    r"### (?P<role>(?:\\(?:\\|###|</turn>|:)|[^\\:])*): (?P<text>(?:\\(?:\\|###|</turn>)|(?!</turn>)[^\\])*) </turn>\n", re.S
)

NODE = (
    "struct<parent:int,start:int,end:int,position:int,loss_start:int,loss_end:int,attends:array<struct<start:int,end:int>>>"
)
PACKS = f"pack string, text string, nodes array<{NODE}>, leaves array<struct<path:string,node:int>>"


def escape(text: str, role: bool = False) -> str:
    """A backslash before every control string and every backslash."""
    return (_ROLE if role else _TEXT).sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group(1), text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and the span of the text in it."""
    head = HEAD + escape(role, True) + MID
    body = escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(text: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at {at}: {text[at:at + 40]!r}")
        out.append((unescape(m["role"]), unescape(m["text"])))
        at = m.end()
    return out


class _Pack:
    def __init__(self) -> None:
        self.text: list[str] = []
        self.size = 0
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.path: list[tuple[tuple[str, str], int]] = []  # turn and node from the root on

    def add(self, key: str, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.path)) and self.path[shared][0] == turns[shared]:
            shared += 1
        del self.path[shared:]
        for turn in turns[shared:]:
            written, low, high = format_turn(*turn)
            parent = self.path[-1][1] if self.path else -1
            attends, position = [], 0
            if parent >= 0:
                above = self.nodes[parent]
                attends = [dict(x) for x in above["attends"]]
                position = above["position"] + above["end"] - above["start"]
            start, end = self.size, self.size + len(written)
            if attends and attends[-1]["end"] == start:
                attends[-1]["end"] = end
            else:
                attends.append({"start": start, "end": end})
            loss = turn[0] == "assistant"
            self.nodes.append(
                {
                    "parent": parent,
                    "start": start,
                    "end": end,
                    "position": position,
                    "loss_start": start + low if loss else None,
                    "loss_end": start + high if loss else None,
                    "attends": attends,
                }
            )
            self.text.append(written)
            self.size = end
            self.path.append((turn, len(self.nodes) - 1))
        self.leaves.append({"path": key, "node": self.path[-1][1]})

    def row(self) -> dict:
        text = "".join(self.text)
        name = hashlib.md5((self.leaves[0]["path"] + "\0" + self.leaves[-1]["path"]).encode()).hexdigest()
        return {"pack": name, "text": text, "nodes": self.nodes, "leaves": self.leaves}


def _pack(limit: int):
    def run(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = _Pack()
        for part in source:
            for key, turns in zip(part["path"], part["turns"]):
                pack.add(key, [(t["role"], t["text"]) for t in turns])
                if pack.size >= limit:
                    yield pd.DataFrame([pack.row()])
                    pack = _Pack()
        if pack.leaves:
            yield pd.DataFrame([pack.row()])

    return run


def conversation_paths(turns: DataFrame) -> DataFrame:
    """conv_id, path, turns of every conversation: rows by turn, ties by role and text; a null role or text is empty."""
    clean = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    whole = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
    whole = whole.withColumn("turns", F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    step = lambda t: F.md5(F.concat(F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]))
    return whole.select("conv_id", F.array_join(F.transform("turns", step), "").alias("path"), "turns")


def chat_packs(paths: DataFrame, limit: int = PACK) -> DataFrame:
    """The packs of all distinct paths of `conversation_paths`."""
    distinct = paths.select("path", "turns").dropDuplicates(["path"])
    return (
        distinct.repartitionByRange("path").sortWithinPartitions("path").mapInPandas(_pack(limit), PACKS)
    )


def format_chats(turns: DataFrame, limit: int = PACK) -> tuple[DataFrame, DataFrame]:
    """(packs, conv_id with its path) of a table with conv_id, turn, role, text.

    Other columns are not looked at. Repeated rows are turns of their own; a null conversation id is one conversation; null
    turns come first. Roles and texts may hold any string, also the marks. An empty table gives no packs.
    """
    paths = conversation_paths(turns)
    return chat_packs(paths, limit), paths.select("conv_id", "path")


def _read(source: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in source:
        out = []
        for text, nodes, leaves in zip(part["text"], part["nodes"], part["leaves"]):
            for leaf in leaves:
                chain, at = [], leaf["node"]
                while at >= 0:
                    chain.append(nodes[at])
                    at = nodes[at]["parent"]
                chain.reverse()
                whole = "".join(text[x["start"] : x["end"]] for x in nodes[leaf["node"]]["attends"])
                loss = "".join(unescape(text[int(x["loss_start"]) : int(x["loss_end"])]) for x in chain if x["loss_start"] is not None and x["loss_start"] == x["loss_start"])
                found = parse(whole)
                out.append(
                    (
                        leaf["path"],
                        len(found),
                        hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in found).encode()).hexdigest(),
                        len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(),
                        len(whole),
                    )
                )
        yield pd.DataFrame(out, columns=["path", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def read_back(packs: DataFrame) -> DataFrame:
    """What each path of the packs holds, from their texts, attention spans and loss masks alone."""
    return packs.select("text", "nodes", "leaves").mapInPandas(
        _read, "path string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


def chat_digest(turns: DataFrame, limit: int = PACK) -> DataFrame:
    """Per conversation what is read back from its pack."""
    packs, members = format_chats(turns, limit)
    return members.join(read_back(packs), "path").select(
        "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )
