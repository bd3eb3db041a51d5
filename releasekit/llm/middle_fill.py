"""Fill-in-middle by displacement scatter.

A document is cut into units (a run of ASCII letters, or one other character) at two places that
a hash of its id picks, and its middle goes to the end behind marks.  A task does this to all
texts of a slice at once, as bytes of one buffer:

1. units and code points are counted by scanning the bytes, which gives every cut its byte;
2. where a part (prefix, middle, suffix) begins, a difference array notes by how much the part's
   shift differs from that of the part before; its cumulative sum is the shift of every byte;
3. one numpy scatter writes all bytes to their places, and the marks into the gaps.

``restore_text`` goes the other way from output and form alone: it finds the marks, builds the
same kind of difference array over the restored buffer, and gathers.

Edge cases: a null text is treated as an empty one, and an empty one stays plain; a text that
holds a mark stays plain, so that marks in an output are never text; the id of a null id is the
empty string; equal ids are cut at equal hashes, repeated rows alike; an empty table gives an
empty one.  Other columns are not read.  Texts are handled whole: a slice ends at ``SLICE_BYTES``
or holds a single longer text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from releasekit.llm.base import byte_slices, query, raw_bytes, table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
#: Per cent of the documents with two cuts that stay plain, and of the others that put the suffix first.
PLAIN_FROM, SPM_BELOW = 90, 20
SLICE_BYTES = 4 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80


def draws(ids: list[str]) -> np.ndarray:
    """Four 32-bit numbers for each id: the first groups of the SHA-256 of ``1:`` and the id."""
    return np.array([np.frombuffer(hashlib.sha256(f"1:{x}".encode()).digest()[:16], ">u4") for x in ids], np.int64).reshape(-1, 4)


def marks(buffer: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Places of ``<P>``, ``<S>`` and ``<M>`` that lie within one text."""
    if len(buffer) < 3:
        return np.empty(0, np.int64)
    inner = buffer[1:-1]
    at = np.flatnonzero((buffer[:-2] == 60) & (buffer[2:] == 62) & ((inner == PREFIX[1]) | (inner == SUFFIX[1]) | (inner == MIDDLE[1])))
    text = np.searchsorted(limits, at, "right") - 1
    return at[at + 3 <= limits[text + 1]]


def shifts(size: int, starts: list[np.ndarray], moves: list[np.ndarray]) -> np.ndarray:
    """The shift of every byte: the parts begin at ``starts``, in rising order text by text, and
    move by ``moves``.  Parts without bytes share their start with the next one."""
    begin, move = np.stack(starts, 1).ravel(), np.stack(moves, 1).ravel()
    rise = np.zeros(size + 1, np.int64)
    np.add.at(rise, begin, np.diff(move, prepend=0))
    return np.cumsum(rise[:size])


def rearrange(buffer: np.ndarray, limits: np.ndarray, drawn: np.ndarray) -> dict[str, np.ndarray]:
    """All texts of a buffer (text ``t`` from ``limits[t]`` to ``limits[t + 1]``): units, form,
    code points of prefix and middle, and the buffer and limits of the outputs."""
    begin, end = limits[:-1], limits[1:]
    first, letter = _FIRST[buffer], _LETTER[buffer]
    opens = first & ~(letter & np.concatenate([[False], letter[:-1]]))
    opens[begin[begin < end]] = True
    units = np.flatnonzero(opens)
    base = np.searchsorted(units, limits)
    n = np.diff(base)
    cuts = np.sort(drawn[:, :2] % (n[:, None] + 1), axis=1)
    place = np.concatenate([units, [0]])
    cut = [np.where(cuts[:, k] < n, place[np.minimum(base[:-1] + cuts[:, k], len(units))], end) for k in (0, 1)]

    plain = (n == 0) | (drawn[:, 2] % 100 >= PLAIN_FROM)
    plain[np.searchsorted(limits, marks(buffer, limits), "right") - 1] = True
    form = np.where(plain, PLAIN, np.where(drawn[:, 3] % 100 < SPM_BELOW, SPM, PSM))

    out_limits = np.concatenate([[0], np.cumsum(end - begin + np.where(plain, 0, 9))])
    out, to = np.empty(out_limits[-1], np.uint8), out_limits[:-1]
    before, after = cut[0] - begin, end - cut[1]
    prefix_at = to + np.select([form == PSM, form == SPM], [3, 6 + after], 0)
    suffix_at = to + np.select([form == PSM, form == SPM], [6 + before, 3], before + cut[1] - cut[0])
    middle_at = to + np.where(plain, before, 9 + before + after)
    shift = shifts(len(buffer), [begin, cut[0], cut[1]], [prefix_at - begin, middle_at - cut[0], suffix_at - cut[1]])
    out[np.arange(len(buffer)) + shift] = buffer
    for mark, at in ((PREFIX, prefix_at), (SUFFIX, suffix_at), (MIDDLE, middle_at)):
        out[at[~plain, None] + np.arange(-3, 0)] = np.frombuffer(mark, np.uint8)

    points = np.concatenate([[0], np.cumsum(first)])
    return {"n": n, "form": form, "prefix_chars": points[cut[0]] - points[begin], "middle_chars": points[cut[1]] - points[cut[0]], "out": out, "limits": out_limits}


def put_back(buffer: np.ndarray, limits: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buffer and limits of the texts that the outputs were made from."""
    begin, end = limits[:-1], limits[1:]
    moved = form != PLAIN
    at = marks(buffer, limits)
    at = at[moved[np.searchsorted(limits, at, "right") - 1]].reshape(-1, 3)  # in an output's order
    where = np.tile(begin[:, None], (1, 3))
    where[moved] = at
    psm = form == PSM
    text_limits = np.concatenate([[0], np.cumsum(end - begin - np.where(moved, 9, 0))])
    to = text_limits[:-1]
    prefix_from = np.where(moved, np.where(psm, where[:, 0], where[:, 1]) + 3, begin)
    suffix_from = np.where(psm, where[:, 1], where[:, 0]) + 3
    middle_from = where[:, 2] + 3
    before = np.where(moved, np.where(psm, where[:, 1], where[:, 2]) - prefix_from, end - begin)
    inside = np.where(moved, end - middle_from, 0)
    middle_to, suffix_to = to + before, to + before + inside
    shift = shifts(int(text_limits[-1]), [to, middle_to, suffix_to], [prefix_from - to, middle_from - middle_to, suffix_from - suffix_to])
    return buffer[np.arange(text_limits[-1]) + shift], text_limits


def _strings(buffer: np.ndarray, limits: np.ndarray):
    import pyarrow as pa

    return pa.Array.from_buffers(pa.large_utf8(), len(limits) - 1, [None, pa.py_buffer(limits.astype(np.int64)), pa.py_buffer(buffer)]).cast(pa.utf8())


def fill_in_middle(documents: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row of ``documents``."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in byte_slices(batches, "text", SLICE_BYTES):
            made = rearrange(*raw_bytes(batch.column("text")), draws(["" if x is None else str(x) for x in batch.column("doc_id").to_pylist()]))
            plain = made["form"] == PLAIN
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made["n"]), pa.array([FORMS[k] for k in made["form"]]), pa.array(made["prefix_chars"], mask=plain), pa.array(made["middle_chars"], mask=plain),
                 _strings(made["out"], made["limits"])],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore_text(outputs: DataFrame) -> DataFrame:
    """``outputs`` with the column ``restored``: the texts, from ``output`` and ``form`` alone."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in byte_slices(batches, "output", SLICE_BYTES):
            form = np.array([FORMS.index(x) for x in batch.column("form").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, _strings(*put_back(*raw_bytes(batch.column("output")), form))], names=[*batch.schema.names, "restored"])

    return outputs.mapInArrow(run, T.StructType([*outputs.schema.fields, T.StructField("restored", T.StringType())]))


UNITS = "[A-Za-z]+|[^A-Za-z]"

SQL = f"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{UNITS}') AS units, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), drawn AS (
    SELECT *, len(units) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
        CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
    FROM hashed
), cut AS (
    SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(units[1:least(c1, c2)], ''), '') AS prefix,
        coalesce(array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS middle,
        coalesce(array_to_string(units[greatest(c1, c2) + 1:n], ''), '') AS suffix
    FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM cut
"""


@query("op11_fill_in_middle", SQL)
def op11_fill_in_middle(spark, sf_dir):
    made = restore_text(fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
