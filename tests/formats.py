"""Writers of the binary formats, from their published descriptions."""

import io
import struct
import zipfile


def dbf(fields, records, deleted=()):
    """``fields`` are (name, code, width, decimals); values are given as bytes."""
    width = 1 + sum(f[2] for f in fields)
    out = struct.pack("<4BIHH20x", 3, 125, 1, 1, len(records), 33 + 32 * len(fields), width)
    for name, code, size, decimals in fields:
        out += struct.pack("<11sc4xBB14x", name.encode(), code.encode(), size, decimals)
    out += b"\r"
    for number, record in enumerate(records):
        out += b"*" if number in deleted else b" "
        for (_, code, size, _), value in zip(fields, record):
            out += value.rjust(size) if code in "NF" else value.ljust(size)
    return out + b"\x1a"


def null_shape():
    return struct.pack("<i", 0)


def point(x, y):
    return struct.pack("<i2d", 1, x, y)


def poly(kind, parts):
    points = [p for part in parts for p in part]
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    out = struct.pack("<i4d2i", kind, min(xs), min(ys), max(xs), max(ys), len(parts), len(points))
    at = 0
    for part in parts:
        out += struct.pack("<i", at)
        at += len(part)
    return out + b"".join(struct.pack("<2d", *p) for p in points)


def shapefile(kind, shapes):
    """``.shp`` and ``.shx`` bytes of record contents."""
    body, index = b"", b""
    for number, content in enumerate(shapes, 1):
        index += struct.pack(">2i", (100 + len(body)) // 2, len(content) // 2)
        body += struct.pack(">2i", number, len(content) // 2) + content

    def head(size):
        return struct.pack(">i20xi", 9994, (100 + size) // 2) + struct.pack("<2i64x", 1000, kind)

    return head(len(body)) + body, head(len(index)) + index


def archive(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in members.items():
            z.writestr(name, content)
    return out.getvalue()


def read_wkb(data):
    """Nested coordinate tuples of a WKB value, with its type."""

    def geometry(at):
        order, kind = struct.unpack_from("<BI", data, at)
        assert order == 1
        at += 5
        if kind == 1:
            return (kind, struct.unpack_from("<2d", data, at)), at + 16
        (count,) = struct.unpack_from("<I", data, at)
        at += 4
        items = []
        for _ in range(count):
            if kind == 2:
                item, at = struct.unpack_from("<2d", data, at), at + 16
            elif kind == 3:
                (n,) = struct.unpack_from("<I", data, at)
                at += 4
                item = [struct.unpack_from("<2d", data, at + 16 * i) for i in range(n)]
                at += 16 * n
            else:
                item, at = geometry(at)
            items.append(item)
        return (kind, items), at

    value, end = geometry(0)
    assert end == len(data)
    return value
