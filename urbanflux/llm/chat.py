r"""Conversations as token sequences with a loss mask, assembled from separately encoded segments.

A turn becomes

    <|im_start|> role \n text <|im_end|> \n

where the two control strings are reserved ids beyond the vocabulary that are spliced
in, never encoded from text. The header ``role \n``, the text and the closing ``\n`` are
encoded one by one, so no token spans a segment's edge. The loss mask of a turn is the
prefix sum of +1 where a trained text begins and -1 where it ends.

What looks like a control string inside a role or a text, ``<|name|>``, gets a backslash
after its first character, one more where there are some already (``<\|name|>``), and
loses it when it is read. A role's own backslashes and line breaks are written ``\\`` and
``\n``, so that the first line break of a turn ends its role.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import ranked, scratch_path, written_table
from urbanflux.llm.token_files import _encoder

START, END = "<|im_start|>", "<|im_end|>"
#: Role whose texts are trained on.
TRAINED = "assistant"
#: Turns of a conversation whose tokens are summed in one window group.
SUMMED = 4096
#: Characters of turns that are encoded or decoded in one call.
CHARACTERS = 4_000_000
_CONTROL = re.compile(r"<(\\*)\|([A-Za-z0-9_]+)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|([A-Za-z0-9_]+)\|>")
_ROLE = re.compile(r"\\(.)")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|\2|>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|\2|>", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Template:
    """Token ids of turns and back; the reserved ids follow the vocabulary's."""

    def __init__(self, vocabulary: str):
        self.encoder = _encoder(vocabulary)
        self.start = self.encoder.tokenizer.get_vocab_size(True)
        self.end = self.start + 1
        self.headers: dict[str, np.ndarray] = {}
        self.line = self.encoder.encode(["\n"])[0].astype(np.int32)

    def _header(self, role: str) -> np.ndarray:
        if role not in self.headers:
            if len(self.headers) > 10_000:
                self.headers.clear()
            self.headers[role] = self.encoder.encode([escape_role(role) + "\n"])[0].astype(np.int32)
        return self.headers[role]

    def turns(self, roles: list[str], texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, mask) of each turn."""
        for role, body in zip(roles, self.encoder.encode([escape(t) for t in texts])):
            header = self._header(role)
            ids = np.concatenate([[self.start], header, body, [self.end], self.line]).astype(np.int32)
            steps = np.zeros(len(ids) + 1, np.int8)
            if role == TRAINED:
                np.add.at(steps, [1 + len(header), 1 + len(header) + len(body)], [1, -1])
            yield ids, np.cumsum(steps[:-1], dtype=np.int8)

    def read(self, ids: list[np.ndarray], masks: list[np.ndarray]) -> pd.DataFrame:
        """role, text, loss (text under the mask) and chars (with control strings and escapes) of each turn."""
        for row in ids:
            if len(row) < 2 + len(self.line) or row[0] != self.start or row[-1 - len(self.line)] != self.end:
                raise ValueError("a turn begins or ends without its reserved id")
        inner = [row[1 : -1 - len(self.line)] for row in ids]
        learned = [row[np.asarray(mask, bool)] for row, mask in zip(ids, masks)]
        decoded = self.encoder.tokenizer.decode_batch([r.tolist() for r in inner + learned], skip_special_tokens=False)
        rows = []
        for body, loss in zip(decoded[: len(inner)], decoded[len(inner) :]):
            role, text = body.split("\n", 1)
            rows.append((unescape_role(role), unescape(text), unescape(loss), len(START) + len(body) + len(END) + 1))
        return pd.DataFrame(rows, columns=["role", "text", "loss", "chars"])


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held >= CHARACTERS:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def format_conversations(turns: DataFrame, vocabulary: str) -> DataFrame:
    """conv_id, place (of the turn, from 1), start (tokens of the conversation before it), ids and mask of every row.

    ``turns`` has conv_id, turn, role and text; other columns are not read. A null text
    or role counts as empty. Rows of a conversation follow by turn, a null turn first;
    rows with one turn by role and MD5 of the text, so repeated rows all stay. Null
    conv_ids are one conversation. Texts of any length are encoded whole. An empty table
    gives an empty result. One row per turn, so a conversation of any length is spread
    over tasks; its tokens are the rows' ids by place, its mask their masks.
    """
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template = Template(vocabulary)
        for batch in batches:
            roles, texts = batch["role"].tolist(), batch["text"].tolist()
            for lo, hi in _slices([len(t) for t in texts]):
                part = batch.iloc[lo:hi][["row", "conv_id", "turn", "role", "digest"]].reset_index(drop=True)
                pairs = list(template.turns(roles[lo:hi], texts[lo:hi]))
                yield part.assign(n=[len(i) for i, _ in pairs], ids=[i for i, _ in pairs], mask=[m for _, m in pairs])

    text = F.coalesce("text", F.lit(""))
    rows = turns.select(
        F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long").cast("string").alias("conv_id"),
        F.col("turn").cast("long").cast("string").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.md5(text.cast("binary")).alias("digest"), text.alias("text"),
    )
    kind = "row long, conv_id string, turn string, role string, digest string, n int, ids array<int>, mask array<tinyint>"
    # Written before it is ordered: a repeated task can't number rows anew, nor encode twice.
    encoded = written_table(rows.mapInPandas(encode, kind), "turns")
    light = encoded.select("row", F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "digest", "n")
    placed = ranked(light, ["conv_id"], ["turn", "role", "digest", "row"], "place").select("row", "conv_id", "place", "n")
    placed = written_table(placed.withColumn("block", F.floor((F.col("place") - 1) / SUMMED)), "places")
    ahead = placed.groupBy("conv_id", "block").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ahead.select(F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_within", F.coalesce(F.sum("n").over(within), F.lit(0)))
    placed = placed.join(ahead, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    placed = placed.select("row", "conv_id", "place", (F.col("_ahead") + F.col("_within")).alias("start"))
    return placed.join(encoded.select("row", "ids", "mask"), "row").drop("row")


def read_conversations(formatted: DataFrame, vocabulary: str) -> DataFrame:
    """conv_id, place, role, text, loss and chars of every turn, from its ids and mask alone."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        template = Template(vocabulary)
        for batch in batches:
            ids, masks = batch["ids"].tolist(), batch["mask"].tolist()
            for lo, hi in _slices([4 * len(i) for i in ids]):
                read = template.read([np.asarray(i, np.int64) for i in ids[lo:hi]], masks[lo:hi])
                yield pd.concat([batch.iloc[lo:hi][["conv_id", "place"]].reset_index(drop=True), read], axis=1)

    kept = formatted.select(F.col("conv_id").cast("string").alias("conv_id"), "place", "ids", "mask")
    read = kept.mapInPandas(decode, "conv_id string, place long, role string, text string, loss string, chars long")
    return read.withColumn("conv_id", F.col("conv_id").cast("long"))


_DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


class _Digest:
    def __init__(self):
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, loss: str, chars: int) -> None:
        self.turns += 1
        self.chars += chars
        self.loss_chars += len(loss)
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(loss.encode())

    def row(self, conv_id) -> tuple:
        return conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def conversation_digests(read: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of every conversation.

    A SHA-256 is a chain over all bytes in order, so the turns of one conversation pass
    one task; they pass as a stream, and no more than a batch is held. Encoding and
    decoding are done before, in any task.
    """
    schema = ", ".join(f"{c} {kind}" for c, kind in zip(_DIGESTS, ("string", "long", "string", "long", "string", "long")))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, now = None, None
        for batch in batches:
            done = []
            for conv_id, *turn in zip(*(batch[c].tolist() for c in ("conv_id", "role", "text", "loss", "chars"))):
                if state is None or conv_id != now:
                    if state is not None:
                        done.append(state.row(now))
                    state, now = _Digest(), conv_id
                state.add(*turn)
            if done:
                yield pd.DataFrame(done, columns=_DIGESTS)
        if state is not None:
            yield pd.DataFrame([state.row(now)], columns=_DIGESTS)

    dealt = read.withColumn("conv_id", F.col("conv_id").cast("string")).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.mapInPandas(digest, schema).withColumn("conv_id", F.col("conv_id").cast("long"))


def formatted_and_read(turns: DataFrame, vocabulary: str) -> DataFrame:
    """The digests of all conversations, read back from the written format."""
    formatted = format_conversations(turns, vocabulary)
    path = scratch_path(turns.sparkSession, "conversations")
    formatted.write.parquet(path)
    again = turns.sparkSession.read.schema(formatted.schema).parquet(path)
    return conversation_digests(read_conversations(again, vocabulary))


CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, n, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as v(n, r)
), escaped as (
  select *, regexp_replace(text, '<(\\*)\|([A-Za-z0-9_]+)\|>', '<\1\\|\2|>', 'g') as body,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|([A-Za-z0-9_]+)\|>', '<\1\\|\2|>', 'g') as head
  from turns
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, md5(text))) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn nulls first, role, md5(text))) as loss_sha256,
  sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1)::bigint as formatted_chars
from escaped group by conv_id
"""
