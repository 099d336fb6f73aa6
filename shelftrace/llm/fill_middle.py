"""Fill-in-the-middle: texts cut in three and put together in another order.

Whole batches are moved as bytes. A scan over the bytes finds where tokens start and so
where each text is cut. A part keeps its bytes in order, so all of them move by the same
distance: a difference array holds the change of that distance at each cut, its running
sum is the shift of every byte, and one scatter writes the outputs. Restoring finds the
markers in the outputs, works out the same shifts and gathers the bytes back.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

# The markers, each three bytes.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = [PREFIX, SUFFIX, MIDDLE]
WIDTH = 3

# Texts are moved some megabytes at a time, and shifts are summed up by windows: a text of
# any length takes a few bytes a byte beside itself.
BYTES_AT_ONCE = 1 << 22
WINDOW = 1 << 18


def draws(id):
    """The four draws of a document: parts of a digest of its id, a null as empty text."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def form_of(text, third, fourth):
    """plain, psm or spm."""
    kept = (text == "") | (third % 100 >= 90)
    for marker in MARKERS:
        kept = kept | F.contains(text, F.lit(marker))
    return F.when(kept, "plain").when(fourth % 100 < 20, "spm").otherwise("psm")


def octets(column):
    """(bytes, bounds) of an Arrow column of texts without nulls."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def text_array(data, bounds):
    """The Arrow column of the texts between `bounds`."""
    return pa.Array.from_buffers(
        pa.string(),
        len(bounds) - 1,
        [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)],
    )


def slices(batch, column):
    """The batch in slices whose texts hold some megabytes, one text at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = np.cumsum(sizes, dtype=np.int64) // BYTES_AT_ONCE
    starts = np.flatnonzero(np.diff(block, prepend=-1)) if len(block) else []
    for start, end in zip(starts, [*starts[1:], len(block)]):
        yield batch.slice(start, end - start)


def token_starts(data, bounds):
    """Which bytes begin a token: a run of A-Z and a-z, or any other code point."""
    folded = data | 32
    letter = (folded >= 97) & (folded <= 122)
    starts = (data & 0xC0) != 0x80
    # The second and later letters of a run begin nothing, unless a text starts there.
    starts[1:] &= ~(letter[1:] & letter[:-1])
    firsts = bounds[:-1][bounds[:-1] < bounds[1:]]
    starts[firsts] = True
    return starts


def code_points(data, bounds, edges):
    """Code points of each text between its two edges (places in `data`)."""
    upto = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return upto[edges[1]] - upto[edges[0]]


def shifts(size, places, changes):
    """(from, to, shift of each byte) by windows: running sums of a difference array."""
    order = np.argsort(places, kind="stable")
    places, changes = places[order], changes[order]
    carry = 0
    for start in range(0, size, WINDOW):
        end = min(start + WINDOW, size)
        low, high = np.searchsorted(places, [start, end])
        steps = np.zeros(end - start, np.int64)
        np.add.at(steps, places[low:high] - start, changes[low:high])
        steps[0] += carry
        moved = np.cumsum(steps)
        carry = moved[-1]
        yield start, end, moved


def laid_out(bounds, cuts, form):
    """Where the parts of each text go. `form` is 0 plain, 1 psm, 2 spm. Returns the
    bounds of the outputs, the difference array as (places, changes) over the texts, and
    the places of the markers."""
    starts, ends = bounds[:-1], bounds[1:]
    first, second = cuts
    prefix, middle, suffix = first - starts, second - first, ends - second
    moved = form > 0
    out = np.concatenate([[0], np.cumsum(ends - starts + 3 * WIDTH * moved)])
    base = out[:-1]
    psm = form == 1
    marks = [
        np.where(psm, base, base + WIDTH + suffix),
        np.where(psm, base + WIDTH + prefix, base),
        base + 2 * WIDTH + prefix + suffix,
    ]
    go = [
        np.where(moved, marks[0] + WIDTH, base) - starts,
        np.where(moved, marks[2] + WIDTH, base + prefix) - first,
        np.where(moved, marks[1] + WIDTH, base + prefix + middle) - second,
    ]
    # The shift at a place is that of the last part that starts there: empty parts take
    # part in the sums and cancel out. Empty texts at the end have no byte to start at.
    whole = np.stack(go, axis=1).ravel()
    places = np.stack([starts, first, second], axis=1).ravel()
    changes = np.diff(whole, prepend=0)
    inside = places < bounds[-1]
    return out, (places[inside], changes[inside]), marks


def scattered(data, bounds, cuts, form):
    """(bytes, bounds) of the outputs."""
    out, (places, changes), marks = laid_out(bounds, cuts, form)
    made = np.zeros(out[-1], np.uint8)
    for start, end, moved in shifts(len(data), places, changes):
        made[np.arange(start, end) + moved] = data[start:end]
    for marker, at in zip(MARKERS, marks):
        for i, octet in enumerate(marker.encode()):
            made[at[form > 0] + i] = octet
    return made, out


def cut_texts(data, bounds, first, second):
    """(tokens, places of both cuts) of every text; a cut lies before the token that the
    draw modulo (tokens + 1) counts, or at the end."""
    at = np.flatnonzero(token_starts(data, bounds))
    ahead = np.searchsorted(at, bounds)
    tokens = np.diff(ahead)
    draws = np.sort(np.stack([first % (tokens + 1), second % (tokens + 1)]), axis=0)
    at = np.append(at, len(data))
    cuts = [
        np.where(units < tokens, at[np.minimum(ahead[:-1] + units, len(at) - 1)], bounds[1:])
        for units in draws
    ]
    return tokens, cuts


FORMS = ["plain", "psm", "spm"]


def transform(docs, id="doc_id", text="text"):
    """(id, n, form, prefix_chars, middle_chars, output) of every document.

    A null text is empty and stays plain; so does one that holds a marker. `n` is the
    number of tokens, also of plain texts. Draws depend on the id alone, so repeated rows
    come out alike, each of them; null ids draw as an empty id. Other columns are ignored,
    whatever their names; an empty table gives an empty result."""
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    first, second, third, fourth = draws("id")
    rows = rows.select(
        "id",
        "text",
        first.alias("first"),
        second.alias("second"),
        form_of(F.col("text"), third, fourth).alias("form"),
    )
    kind = dict(rows.dtypes)["id"]

    def move(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                data, bounds = octets(part.column("text"))
                form = pc.index_in(part.column("form"), pa.array(FORMS)).to_numpy()
                drawn = [part.column(c).to_numpy() for c in ("first", "second")]
                tokens, cuts = cut_texts(data, bounds, *drawn)
                made, out = scattered(data, bounds, cuts, form)
                plain = form == 0
                sizes = [
                    pa.array(code_points(data, bounds, edges), pa.int64(), mask=plain)
                    for edges in ((bounds[:-1], cuts[0]), cuts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(tokens, pa.int64()), part.column("form"), *sizes, text_array(made, out)],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows.mapInArrow(
        move,
        f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string",
    ).withColumnRenamed("id", id)


def gathered(data, bounds, form):
    """(bytes, bounds) of the texts that the outputs were made of: from the outputs and
    their forms alone."""
    starts, ends = bounds[:-1], bounds[1:]
    moved = form > 0
    # A moved text holds each marker once, in the order that its form names. What looks
    # like one may also lie across two texts, or in a plain text.
    marked = (data[:-2] == ord("<")) & (data[2:] == ord(">"))
    at = np.flatnonzero(marked & np.isin(data[1:-1], [ord(m[1]) for m in MARKERS]))
    owner = np.searchsorted(bounds, at, side="right") - 1
    at = at[moved[owner] & (at + WIDTH <= ends[owner])].reshape(-1, 3)
    marks = np.zeros((3, len(form)), np.int64)
    marks[:, moved] = at.T
    prefix, middle, suffix = np.zeros((3, len(form)), np.int64)
    psm, spm = form == 1, form == 2
    prefix[psm] = (marks[1] - marks[0])[psm] - WIDTH
    suffix[psm] = (marks[2] - marks[1])[psm] - WIDTH
    suffix[spm] = (marks[1] - marks[0])[spm] - WIDTH
    prefix[spm] = (marks[2] - marks[1])[spm] - WIDTH
    middle[moved] = (ends - marks[2])[moved] - WIDTH
    size = np.where(moved, prefix + middle + suffix, ends - starts)
    own = np.concatenate([[0], np.cumsum(size)])
    cuts = [own[:-1] + np.where(moved, prefix, size), own[:-1] + np.where(moved, prefix + middle, size)]
    _, (places, changes), _ = laid_out(own, cuts, form)
    made = np.empty(own[-1], np.uint8)
    for start, end, shift in shifts(len(made), places, changes):
        made[start:end] = data[np.arange(start, end) + shift]
    return made, own


def restore(rows, output="output", form="form", restored="restored"):
    """The rows with the text that each output was made of, from output and form. Null
    outputs give empty texts. A column of that name is replaced."""
    rows = rows.drop(restored)
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)

    def gather(batches):
        for batch in batches:
            for part in slices(batch, output):
                data, bounds = octets(pc.fill_null(part.column(output), ""))
                forms = pc.index_in(part.column(form), pa.array(FORMS)).to_numpy()
                texts = text_array(*gathered(data, bounds, forms))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, texts], names=[*part.schema.names, restored]
                )

    return rows.mapInArrow(gather, f"{kinds}, `{restored}` string")
