"""Aggregated records as flat bytes: many messages are read or made at once, by numpy over the buffers of a whole Arrow batch.

A message is a chain of fields, each of which says where the next one begins. The chains of all records of a batch advance
together, a field of each at a time; the last few, which are long, are walked one by one. Then the chains of all entries
advance together. Nothing is made for an entry but numbers: data and keys are gathered as byte ranges.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from logtide.functions.keys import CHECKSUM_BYTES, MAGIC

_MAGIC = np.frombuffer(bytes.fromhex(MAGIC), np.uint8)
#: Chains that advance together at least.
FEW = 48
#: Explicit hash key that fills the table of an aggregated record; no entry points to it.
FILLER = "0"


class CorruptRecord(ValueError):
    """The magic number is there, the checksum or message is wrong."""


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; nulls are empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each length, one after the other."""
    first = np.cumsum(length) - length
    return np.repeat(start - first, length) + np.arange(int(length.sum()))


def gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow array of byte ranges."""
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    values = np.ascontiguousarray(data[spans(start, length)])
    large = pa.large_binary() if pa.types.is_binary(kind) else pa.large_string()
    out = pa.Array.from_buffers(large, len(length), [None, pa.py_buffer(offsets), pa.py_buffer(values)])
    if not pa.types.is_binary(kind):
        out.validate(full=True)
    return out.cast(kind)


#: Bytes of a number in variable length, and what is read as one that is longer than any.
_BYTES, _WRONG = 9, -1


def numbers_at(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, position behind it) of the variable-length numbers at these positions; the value is negative where there is none of 63 bits."""
    value = data[at].astype(np.int64)
    end = at + 1
    live = np.flatnonzero(value >= 0x80)
    value[live] &= 0x7F
    for k in range(1, _BYTES):
        if not len(live):
            return value, end
        byte = data[at[live] + k].astype(np.int64)
        value[live] |= (byte & 0x7F) << 7 * k
        end[live] += 1
        live = live[byte >= 0x80]
    value[live] = _WRONG
    return value, end


def fields_at(data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, wire type, value or where the bytes begin, position behind it, whether it is sound) of the fields at these positions."""
    tag, body = numbers_at(data, at)
    body = np.minimum(body, len(data) - _BYTES)
    value, after = numbers_at(data, body)
    wire = tag & 7
    delimited = wire == 2
    begin = after
    after = after + np.where(delimited, np.minimum(value, len(data)), 0)
    sound = (tag >= 0) & (value >= 0) & (delimited | (wire == 0)) & (after <= end)
    return tag >> 3, wire, np.where(delimited, begin, value), after, sound


def walked(data: bytes, at: int, end: int) -> tuple[list[int], bool]:
    """Where the fields of one message begin, and whether all is a chain of fields."""
    found: list[int] = []
    add = found.append
    while at < end:
        add(at)
        tag, size = data[at], data[at + 1]
        if tag & 0x87 == 2 and size < 0x80:
            at += 2 + size
            continue
        both = []
        for _ in range(2):
            value = shift = 0
            while True:
                if at >= end or shift > 56:
                    return found[:-1], False
                value |= (data[at] & 0x7F) << shift
                at, shift = at + 1, shift + 7
                if data[at - 1] < 0x80:
                    break
            both.append(value)
        if both[0] & 7 == 2:
            at += both[1]
        elif both[0] & 7:
            return found[:-1], False
    return (found, True) if at == end else (found[:-1], False)


def message_fields(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(message, number, beginning, end) of the byte fields of messages, in order, and which messages are no chain of fields."""
    bad = np.zeros(len(start), bool)
    at, live = start.copy(), np.flatnonzero(start < end)
    found: list[tuple] = []
    while len(live) >= FEW:
        number, wire, value, after, sound = fields_at(data, at[live], end[live])
        sound &= (wire == 2) | (number < 1) | (number > 3)
        bad[live[~sound]] = True
        own = np.flatnonzero(sound & (wire == 2))
        found.append((live[own], number[own], value[own], after[own]))
        live, after = live[sound], after[sound]
        at[live] = after
        live = live[after < end[live]]
    raw = data.tobytes() if len(live) else b""
    for m in live.tolist():
        begin, sound = walked(raw, int(at[m]), int(end[m]))
        bad[m] = not sound
        number, wire, value, after, _ = fields_at(data, np.array(begin, np.int64), end[m])
        bad[m] |= bool(((wire != 2) & (number >= 1) & (number <= 3)).any())
        own = np.flatnonzero(wire == 2)
        found.append((np.full(len(own), m), number[own], value[own], after[own]))
    of, number, begin, stop = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 4
    order = np.argsort(begin, kind="stable")
    return of[order], number[order], begin[order], stop[order], bad


def ranks(groups: np.ndarray) -> np.ndarray:
    """The number of each among those of its group; groups stand together."""
    if not len(groups):
        return np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    return np.arange(len(groups)) - np.repeat(heads, np.diff(np.append(heads, len(groups))))


class Decoded:
    """Entries of aggregated records, in order: record, place in it, spans of data, and the keys' arrays with each entry's places in them."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        low, high = offsets[:-1], offsets[1:]
        long = high - low >= len(_MAGIC)
        head = np.zeros(len(low), bool)
        some = np.flatnonzero(long)
        head[some] = (data[low[some][:, None] + np.arange(len(_MAGIC))] == _MAGIC).all(1)
        #: Which records carry the magic number.
        self.marked = head
        some = np.flatnonzero(head)
        start, end = low[some] + len(_MAGIC), high[some] - CHECKSUM_BYTES
        sound = end >= start
        padded = np.concatenate([data, np.zeros(2 * _BYTES, np.uint8)])
        view = memoryview(padded)
        for i, (a, b) in enumerate(zip(start.tolist(), end.tolist())):
            if sound[i]:
                sound[i] = hashlib.md5(view[a:b]).digest() == view[b : b + CHECKSUM_BYTES]
        of, number, begin, stop, bad = message_fields(padded, start[sound], end[sound])
        length = stop - begin

        def table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            own = np.flatnonzero((number == n) & ~bad[of])
            count = np.bincount(of[own], minlength=len(bad))
            return own, np.cumsum(count) - count, count

        own, _, _ = table(3)
        at, last, record = begin[own].copy(), stop[own], of[own]
        key, hashed = np.full(len(own), -1), np.full(len(own), -1)
        body_at, body_size = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        live = np.flatnonzero(at < last)
        while len(live):  # as many turns as the largest entry has fields
            n, wire, value, after, good = fields_at(padded, at[live], last[live])
            good &= np.where((n == 1) | (n == 2), wire == 0, np.where((n == 3) | (n == 4), wire == 2, True))
            bad[record[live[~good]]] = True
            for which, into in ((1, key), (2, hashed), (3, body_at)):
                hit = good & (n == which)
                into[live[hit]] = value[hit]
            body_size[live[hit]] = after[hit] - value[hit]
            live, after = live[good], after[good]
            at[live] = after
            live = live[after < last[live]]
        keys, key_first, key_count = table(1)
        hashes, hash_first, hash_count = table(2)
        for table_of in (keys, hashes):  # keys that are no text
            try:
                gathered(data, begin[table_of], length[table_of], pa.string())
            except pa.ArrowInvalid:
                for i in table_of.tolist():
                    try:
                        data[begin[i] : begin[i] + length[i]].tobytes().decode()
                    except UnicodeDecodeError:
                        bad[of[i]], length[i] = True, 0
        lost = (key < 0) | (key >= key_count[record]) | (hashed >= hash_count[record])
        bad[record[lost]] = True
        #: Records whose checksum or message is wrong.
        self.corrupt = np.zeros(len(low), bool)
        self.corrupt[some[~sound]] = True
        rows = some[sound]
        self.corrupt[rows[bad]] = True
        kept = np.flatnonzero(~bad[record])
        self.row, self.place = rows[record[kept]], ranks(record)[kept]
        self.body = gathered(data, body_at[kept], body_size[kept], pa.binary())
        # places count on from record to record, among the tables of sound ones: bad ones have none that are asked for
        self.keys = gathered(data, begin[keys], length[keys], pa.string())
        self.hashes = gathered(data, begin[hashes], length[hashes], pa.string())
        self.key = key_first[record[kept]] + key[kept]
        self.hash = np.where(hashed[kept] >= 0, hash_first[record[kept]] + hashed[kept], -1)


def number_sizes(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), np.int64)
    for k in range(1, 9):
        out += values >= 1 << 7 * k
    return out


def put_numbers(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Write numbers in variable length; returns where each ends."""
    size = number_sizes(values)
    for k in range(int(size.max(initial=0))):
        own = size > k
        out[at[own] + k] = values[own] >> 7 * k & 0x7F | np.where(size[own] > k + 1, 0x80, 0)
    return at + size


def encoded(lengths: np.ndarray, keys: pa.Array, bodies: pa.Array) -> pa.Array:
    """Aggregated records of ``lengths`` entries each (partition key, data): each key stands once, in the order of first use."""
    records = len(lengths)
    owner = np.repeat(np.arange(records), lengths)
    codes = keys.dictionary_encode()
    names, name_offsets = flat(codes.dictionary)
    name_size = np.diff(name_offsets)
    code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, first, back = np.unique(owner * max(len(name_size), 1) + code, return_index=True, return_inverse=True)
    order = np.argsort(first, kind="stable")  # keys in the order of their first use
    used = first[order]
    place = np.empty(len(order), np.int64)
    place[order] = ranks(owner[used])
    index = place[back]
    data, offsets = flat(bodies)
    size = np.diff(offsets)
    # sizes of all fields, then where each begins
    named = name_size[code[used]]
    key_total = 1 + number_sizes(named) + named
    inner = 1 + number_sizes(index) + 1 + number_sizes(size) + size
    entry_total = 1 + number_sizes(inner) + inner
    filler = np.frombuffer(bytes([2 << 3 | 2, len(FILLER)]) + FILLER.encode(), np.uint8)
    per = lambda of, x: np.bincount(of, x, minlength=records).astype(np.int64)
    head, tables, entries = len(_MAGIC), per(owner[used], key_total), per(owner, entry_total)
    total = head + tables + lengths * len(filler) + entries + CHECKSUM_BYTES
    begin = np.cumsum(total) - total
    out = np.zeros(int(total.sum()), np.uint8)
    out[begin[:, None] + np.arange(head)] = _MAGIC

    def starts(of: np.ndarray, sizes: np.ndarray, base: np.ndarray) -> np.ndarray:
        before = np.cumsum(sizes) - sizes
        heads = np.searchsorted(of, np.arange(records))
        return base[of] + before - before[np.minimum(heads, max(len(before) - 1, 0))][of] if len(of) else before

    at = starts(owner[used], key_total, begin + head)
    out[at] = 1 << 3 | 2
    at = put_numbers(out, at + 1, named)
    out[spans(at, named)] = names[spans(name_offsets[code[used]], named)]
    at = spans(begin + head + tables, lengths * len(filler))
    out[at] = np.tile(filler, int(lengths.sum()))
    at = starts(owner, entry_total, begin + head + tables + lengths * len(filler))
    out[at] = 3 << 3 | 2
    at = put_numbers(out, at + 1, inner)
    out[at] = 1 << 3
    at = put_numbers(out, at + 1, index)
    out[at] = 3 << 3 | 2
    at = put_numbers(out, at + 1, size)
    out[spans(at, size)] = data
    view = memoryview(out)
    for a, b in zip((begin + head).tolist(), (begin + total - CHECKSUM_BYTES).tolist()):
        out[b : b + CHECKSUM_BYTES] = np.frombuffer(hashlib.md5(view[a:b]).digest(), np.uint8)
    ends = np.concatenate([[0], np.cumsum(total)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), records, [None, pa.py_buffer(ends), pa.py_buffer(out)]).cast(pa.binary())
