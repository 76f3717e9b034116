"""Chat formatting of typed content parts.

A message has a role and parts of type text, image, audio or document. A visitor flattens the parts
into one string: escaped text, and for each attachment a placeholder, whose reference, place and
expanded token count are recorded in order. The template is ::

    <|im_start|>role\\nparts<|im_end|>\\n

Two texts in a row have ``<|part|>`` between them, and so has an empty text beside an attachment. Control strings inside texts are those of the template
and those that common models know; each gets a backslash after its first character, more if it
has some already, so that escaping is undone by taking one away, and an unescaped control string is always
the template's. A role's backslashes and line feeds are escaped, so that it stays one line.

``format`` orders the messages of all conversations by a range-partitioned sort and lays those of one
conversation one after another, streaming, as chunks of whole messages: one chunk for a conversation of
usual length, several for a long one or one that two tasks share. A conversation of any length is
never one cell. The loss mask is a list of spans over the texts of the assistant.

Cases: a null text or part counts as empty text, a null or empty list of parts as no text, a null
role as the empty role; a part of another type is text if it has no reference, else a document;
unknown sizes count as one tile, second or page; null conversations are one, null turns come first,
and messages of one turn are ordered by role, then by the digest of their string; repeated rows
are all kept; a very long message is a chunk of its own; an empty table has no chunks; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
START, END, BETWEEN = "<|im_start|>", "<|im_end|>\n", "<|part|>"
PLACEHOLDERS = {kind: f"<|{kind}|>" for kind in ("image", "audio", "document")}
#: Code points of a chunk from which it is closed.
CHUNK = 1 << 16

#: fixed values: how control strings go on after < or [
_REST = r"\|[A-Za-z0-9_]+\|>|/?(?:s|SYS|unk|pad)>|/?INST\]"
_PLAIN = re.compile(rf"([<\[])\\(\\*)(?={_REST})")
_MESSAGE = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ATTACHED = re.compile("|".join(map(re.escape, PLACEHOLDERS.values())))

_SPANS = "array<struct<start:bigint,end:bigint>>"
_ATTACHMENTS = "array<struct<kind:string,ref:string,tokens:bigint,at:bigint>>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_REST})", r"$1\\$2")


def plain(text: str) -> str:
    """The text that ``escaped`` had."""
    return _PLAIN.sub(r"\1\2", text)


@dataclass(frozen=True)
class Visitor:
    """What a part becomes: its string, and for an attachment kind, reference and expanded tokens.

    An image counts a token for each tile of ``tile`` pixels and one more, audio ``per_second`` and a
    document ``per_page`` tokens.
    """

    tile: int = 28
    per_second: int = 25
    per_page: int = 1024

    def visit(self, part: Column) -> Column:
        kind = F.lower(part["type"])
        other = (part["ref"].isNotNull()) & ~F.coalesce(kind == "text", F.lit(False))
        return (F.when(kind == "image", self.image(part)).when(kind == "audio", self.audio(part))
                .when((kind == "document") | other, self.document(part)).otherwise(self.text(part)))

    def text(self, part: Column) -> Column:
        none = F.lit(None).cast("string")
        return self._flat(escaped(F.coalesce(part["text"], F.lit(""))), none, none, F.lit(0))

    def image(self, part: Column) -> Column:
        tiles = [F.ceil(F.greatest(F.coalesce(part[c], F.lit(1)), F.lit(1)) / self.tile) for c in ("width", "height")]
        return self._attached("image", part, tiles[0] * tiles[1] + 1)

    def audio(self, part: Column) -> Column:
        seconds = F.coalesce(F.nanvl(part["seconds"], F.lit(None)), F.lit(1.0))
        return self._attached("audio", part, F.greatest(F.ceil(seconds * self.per_second), F.lit(1)))

    def document(self, part: Column) -> Column:
        return self._attached("document", part, F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * self.per_page)

    def _attached(self, kind: str, part: Column, tokens: Column) -> Column:
        return self._flat(F.lit(PLACEHOLDERS[kind]), F.lit(kind), part["ref"], tokens)

    @staticmethod
    def _flat(string: Column, kind: Column, ref: Column, tokens: Column) -> Column:
        return F.struct(string.alias("string"), kind.alias("kind"), ref.alias("ref"), tokens.cast("bigint").alias("tokens"))


def text_part(text: str) -> Column:
    """A column of plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.col(text).cast("string").alias("text")))


def _whole(parts: DataFrame) -> Column:
    """The parts with all fields of ``PART``; fields that the input lacks are null."""
    has = {f.name for f in parts.schema["_parts"].dataType.elementType.fields}
    kinds = [x.split(":") for x in PART[len("struct<") : -1].split(",")]
    return F.transform("_parts", lambda p: F.struct(*[
        (p[name] if name in has else F.lit(None)).cast(kind).alias(name) for name, kind in kinds]))


def messages(df: DataFrame, parts: Column, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             visitor: Visitor | None = None, assistant: str = "assistant") -> DataFrame:
    """conv_id, turn, role, ``string``, ``spans`` and ``attachments`` of each message; places count from its start."""
    visitor = visitor or Visitor()
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), parts.alias("_parts"))
    line = F.replace(F.replace("role", F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    flat = F.coalesce(F.transform(_whole(rows), visitor.visit), F.array())
    rows = rows.select("*", F.concat(F.lit(START), line, F.lit("\n")).alias("_head"), flat.alias("_flat"))

    def between(p, i):
        before = F.get("_flat", i - 1)
        texts = p["kind"].isNull() & before["kind"].isNull()
        apart = (i > 0) & (texts | (p["string"] == "") | (before["string"] == ""))
        return F.struct(F.when(apart, F.lit(BETWEEN)).otherwise(F.lit("")).alias("before"), p.alias("p"))

    rows = rows.withColumn("_flat", F.transform("_flat", between))

    def laid(acc, x):
        at = acc["at"] + F.length(x["before"])
        end = at + F.length(x["p"]["string"])
        span = F.array(F.struct(at.alias("start"), end.alias("end")))
        record = F.array(F.struct(x["p"]["kind"].alias("kind"), x["p"]["ref"].alias("ref"), x["p"]["tokens"].alias("tokens"), at.alias("at")))
        text = x["p"]["kind"].isNull()
        return F.struct(end.alias("at"), F.when(text, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"),
                        F.when(text, acc["attachments"]).otherwise(F.concat(acc["attachments"], record)).alias("attachments"))

    none = F.struct(F.length("_head").cast("bigint").alias("at"), F.array().cast(_SPANS).alias("spans"),
                    F.array().cast(_ATTACHMENTS).alias("attachments"))
    body = F.array_join(F.transform("_flat", lambda x: F.concat(x["before"], x["p"]["string"])), "")
    rows = rows.select("conv_id", "turn", "role", F.concat("_head", body, F.lit(END)).alias("string"),
                       F.aggregate("_flat", none, laid).alias("_laid"))
    spans = F.when(F.col("role") == assistant, F.col("_laid.spans")).otherwise(F.array().cast(_SPANS))
    return rows.select("conv_id", "turn", "role", "string", spans.alias("spans"), F.col("_laid.attachments").alias("attachments"))


def format(df: DataFrame, parts: Column, visitor: Visitor | None = None, chunk: int = CHUNK, **names) -> DataFrame:
    """Chunks of formatted conversations: conv_id, part, chunk (their order), n_turns, formatted, spans, attachments.

    A chunk is closed at ``chunk`` code points. ``names`` are those of ``messages``.
    """
    rows = messages(df, parts, visitor=visitor, **names)
    # the row number parts rows that are equal in all else, should one message be a large share of all
    order = ["conv_id", "turn", "role", F.sha2("string", 256), F.monotonically_increasing_id()]
    dealt = rows.withColumns({"_digest": order[3], "_at": order[4]}).repartitionByRange(
        "conv_id", "turn", "role", "_digest", "_at").sortWithinPartitions("conv_id", "turn", "role", "_digest", "_at")
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)]).add("part", "integer").add("chunk", "long").add("n_turns", "long").add(
        "formatted", "string").add("spans", T.DataType.fromDDL(_SPANS)).add("attachments", T.DataType.fromDDL(_ATTACHMENTS))
    return dealt.select("conv_id", "string", "spans", "attachments").mapInArrow(
        lambda batches: _laid_out(batches, chunk), schema)


class _Chunk:
    """Messages of one conversation, one after another."""

    def __init__(self, conv, number: int):
        self.conv, self.number, self.strings, self.size, self.spans, self.attachments = conv, number, [], 0, [], []

    def add(self, string: str, spans: list[dict], attachments: list[dict]) -> None:
        self.strings.append(string)
        self.spans += [{"start": s["start"] + self.size, "end": s["end"] + self.size} for s in spans]
        self.attachments += [a | {"at": a["at"] + self.size} for a in attachments]
        self.size += len(string)


def _laid_out(batches, limit: int) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    now, kind, closed, size = None, None, [], 0

    def out():
        kinds = [kind, pa.int32(), pa.int64(), pa.int64(), pa.string(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                 pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64()), ("at", pa.int64())]))]
        rows = [(c.conv, part, c.number, len(c.strings), "".join(c.strings), c.spans, c.attachments) for c in closed]
        return pa.RecordBatch.from_arrays(
            [pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["conv_id", "part", "chunk", "n_turns", "formatted", "spans", "attachments"])

    for b in batches:
        kind = b.column("conv_id").type
        for conv, string, spans, attachments in zip(*(b.column(c).to_pylist() for c in b.schema.names), strict=True):
            if now is None or now.conv != conv or now.size >= limit:
                if now is not None:
                    closed.append(now)
                    size += now.size
                now = _Chunk(conv, now.number + 1 if now is not None and now.conv == conv else 0)
            now.add(string, spans, attachments)
            if size >= limit:
                yield out()
                closed, size = [], 0
    if now is not None:
        closed.append(now)
        yield out()


def read(formatted: str) -> Iterator[tuple[str, list[str | None]]]:
    """Role and parts of each message of a chunk: unescaped texts, and None for an attachment."""
    for m in _MESSAGE.finditer(formatted):
        role = re.sub(r"\\(.)", lambda x: "\n" if x[1] == "n" else x[1], m[1])
        yield role, _parts(m[2])


def _parts(body: str) -> list[str | None]:
    out: list[str | None] = []
    for group in body.split(BETWEEN):
        pieces = _ATTACHED.split(group)
        out.append(plain(pieces[0]))
        for piece in pieces[1:]:
            if out[-1] == "":
                out.pop()
            out += [None, plain(piece)]
        if len(pieces) > 1 and out[-1] == "":
            out.pop()
    return out


def digests(chunks: DataFrame) -> DataFrame:
    """What is read back of each conversation: turns, texts under the loss mask and formatted length.

    A digest is sequential, so the chunks of a conversation stream through one task, one at a time.
    """
    kind = chunks.schema["conv_id"].dataType
    schema = T.StructType([T.StructField("conv_id", kind)]).add("n_turns", "long").add("turns_sha256", "string").add(
        "loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")
    dealt = chunks.select("conv_id", "part", "chunk", "formatted", "spans").repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "part", "chunk").mapInArrow(_digested, schema)


def _digested(batches) -> Iterator[pa.RecordBatch]:
    now, kind, done = None, None, []
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def out():
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        rows = [(c, n, t.hexdigest(), k, s.hexdigest(), f) for c, n, t, k, s, f in done]
        return pa.RecordBatch.from_arrays([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    for b in batches:
        kind = b.column("conv_id").type
        for i in range(b.num_rows):
            conv, formatted, spans = (b.column(c)[i].as_py() for c in ("conv_id", "formatted", "spans"))
            if now is None or now[0] != conv:
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                done.append(now)
            for role, parts in read(formatted):
                now[1] += 1
                now[2].update(f"{role}\n{''.join(p or '' for p in parts)}\n".encode())
            for s in spans:
                text = plain(formatted[s["start"] : s["end"]])
                now[3] += len(text)
                now[4].update(text.encode())
            now[5] += len(formatted)
        if len(done) > 1000:
            *done, last = done
            yield out()
            done = [last]
    if done:
        yield out()
