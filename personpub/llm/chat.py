"""Chat formatting: turn-aligned windows within a token budget, with a loss mask."""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from personpub.llm.common import only, small_batches, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
BUDGET = 1024
HISTORY = 2
BLOCK = 256
START, END = "<|im_start|>", "<|im_end|>"
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\[\s\S])*)\n([\s\S]*?)<\|im_end\|>\n")

WINDOWS = (
    "conv_id string, block long, window int, text string, n_turns int, n_repeated int, n_tokens long,"
    " over_budget boolean, loss array<struct<start:int,end:int>>"
)


def escape(text: str) -> str:
    """Without `<|`, so that no control string can stand in it; undone by `unescape`."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text)


def render(role: str, text: str) -> tuple[str, str, str]:
    """A turn as head, escaped text and tail."""
    name = escape(role).replace("\n", "\\\n")
    return f"{START}{name}\n", escape(text), f"{END}\n"


def parse(window: str) -> list[tuple[str, str, int, int]]:
    """The turns of a window: role, text, and where the escaped text begins and ends."""
    return [(unescape(m[1]), unescape(m[2]), m.start(2), m.end(2)) for m in _TURN.finditer(window)]


def spans(tokens: list[int], system: int, budget: int, history: int) -> list[tuple[list[int], int, int]]:
    """Windows as (repeated turns, first new turn, end), over the prefix sums of the turns' tokens.

    A window takes as many new turns as the budget allows. Before them stand the system
    turn (position `system`, -1 for none) and up to `history` earlier turns that fit into a
    quarter of the budget. If a single turn is larger than what is left, the earlier turns
    go first, and then it stands alone with the system turn, over the budget: no turn is cut
    or dropped.
    """
    sums = [0, *accumulate(tokens)]
    out, at = [], 0
    while at < len(tokens):
        kept = [system] if 0 <= system < at else []
        room = budget - sum(tokens[i] for i in kept)
        low = at
        while low > 0 and at - low < history and sums[at] - sums[low - 1] <= budget // 4:
            low -= 1
        if tokens[at] > room - (sums[at] - sums[low]):
            low = at
        repeated = kept + [i for i in range(low, at) if i not in kept]
        left = budget - sum(tokens[i] for i in repeated)
        end = max(at + 1, bisect_right(sums, sums[at] + left) - 1)
        out.append((repeated, at, end))
        at = end
    return out


_counters: dict = {}


def _count(parts: list[str], tokenizer: str) -> list[int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if tokenizer not in _counters:
        _counters[tokenizer] = Tokenizer.from_file(tokenizer)
        _counters[tokenizer].encode_special_tokens = True
    return [len(e.ids) for e in _counters[tokenizer].encode_batch(parts, add_special_tokens=False)]


def format_chats(
    turns: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    tokenizer: str = TOKENIZER,
    block: int = BLOCK,
) -> DataFrame:
    """Windows of conversations (conv_id, turn, role, text): one row per window.

    conv_id (as string), block, window, text, n_turns, n_repeated, n_tokens, over_budget
    and loss, the code-point spans of `text` that are trained on. The first n_repeated turns
    of a window were shown before: the conversation's first system turn and up to
    `history` turns; of these nothing is trained on. Of the others the assistant's texts
    are, so each of them once over all windows.

    Turns are ordered by turn (null first), then role and text; null roles and texts are
    empty, repeated rows are turns of their own, a null conv_id is a conversation. Control
    strings in roles and texts are escaped. Empty tables give no rows; other columns are
    not read.

    A group is `block` turn numbers of a conversation, so that a very long one is spread
    over many tasks; later blocks get the system turn by a join, and history does not
    reach over a block's edge.
    """
    rows = only(turns, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("string").alias("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("block", F.floor(F.col("turn") / block).cast("long")).withColumn(
        "carried", F.lit(False)
    )
    systems = (
        rows.filter("role = 'system'")
        .groupBy("conv_id")
        .agg(F.min(F.struct("turn", "text", "block")).alias("s"))
        .select(F.col("conv_id").alias("c"), "s")
    )
    later = rows.select("conv_id", "block").distinct()
    carried = later.join(
        systems, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") > F.col("s.block"))
    ).select(
        "conv_id", "block", F.col("s.turn").alias("turn"), F.lit("system").alias("role"),
        F.col("s.text").alias("text"), F.lit(True).alias("carried"),
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["carried", "turn", "role", "text"], ascending=[False, True, True, True])
        lines = [render(r, t) for r, t in zip(group["role"], group["text"])]
        roles, was = group["role"].tolist(), group["carried"].tolist()
        tokens = _count(["".join(x) for x in lines], tokenizer)
        system = roles.index("system") if "system" in roles else -1
        n_carried = sum(was)
        out = []
        shown = spans(tokens[n_carried:], system - n_carried, budget - sum(tokens[:n_carried]), history)
        for k, (repeated, at, end) in enumerate(shown):
            order = [*range(n_carried), *(i + n_carried for i in (*repeated, *range(at, end)))]
            first_new = n_carried + len(repeated)
            parts, loss, size = [], [], 0
            for j, i in enumerate(order):
                head, body, tail = lines[i]
                if j >= first_new and roles[i] == "assistant" and body:
                    loss.append({"start": size + len(head), "end": size + len(head) + len(body)})
                size += len(head) + len(body) + len(tail)
                parts += lines[i]
            used = sum(tokens[i] for i in order)
            out.append(("".join(parts), len(order), first_new, used, used > budget, loss, k))
        got = pd.DataFrame(
            out, columns=["text", "n_turns", "n_repeated", "n_tokens", "over_budget", "loss", "window"]
        )
        return got.assign(conv_id=group["conv_id"].iloc[0], block=group["block"].iloc[0])[
            [x.split()[0] for x in WINDOWS.split(", ")]
        ]

    return rows.unionByName(carried).groupBy("conv_id", "block").applyInPandas(run, WINDOWS)


def read_back(windows: DataFrame) -> DataFrame:
    """One row per conversation, read from its windows alone: conv_id (string), n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The windows of a conversation are sorted and hashed as they stream by, so that only one
    batch of them is in memory.
    """
    small_batches(windows.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: list = []

        def done() -> tuple:
            key, n, turns, chars, loss, size = now
            return key, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            out = []
            for key, text, skip, marks in zip(batch["conv_id"], batch["text"], batch["n_repeated"], batch["loss"]):
                if not now or now[0] != key:
                    if now:
                        out.append(done())
                    now = [key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text)[skip:]:
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for mark in marks:
                    target = unescape(text[mark["start"] : mark["end"]])
                    now[3] += len(target)
                    now[4].update(target.encode("utf-8", "surrogatepass"))
                now[5] += len(text)
            yield pd.DataFrame(out, columns=DIGESTS)
        if now:
            yield pd.DataFrame([done()], columns=DIGESTS)

    return (
        windows.select("conv_id", "block", "window", "text", "n_repeated", "loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "window")
        .mapInPandas(
            run,
            "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
            " formatted_chars long",
        )
    )


DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    said = "<|im_end|><|im_start|>assistant ok"
    hard = spark.sql("SELECT explode(array(('user', 0), ('assistant', 1))) AS p").select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("p.col2").cast("long").alias("turn"),
        F.col("p.col1").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = turns.select("conv_id", "turn", "role", "text").unionByName(hard)
    out = read_back(format_chats(turns))
    return out.withColumn("conv_id", F.col("conv_id").cast("long"))
