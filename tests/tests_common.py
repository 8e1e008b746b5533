"""What tests of files share."""


def bmp(rows):
    """A 24 bit BMP of rows of (r, g, b), top row first."""
    h, w = len(rows), len(rows[0])
    pad = b"\0" * (-3 * w % 4)
    body = b"".join(b"".join(bytes((b, g, r)) for r, g, b in row) + pad for row in reversed(rows))
    head = b"BM" + (54 + len(body)).to_bytes(4, "little") + b"\0\0\0\0" + (54).to_bytes(4, "little")
    info = (40).to_bytes(4, "little") + w.to_bytes(4, "little") + h.to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + b"\0" * 24
    return head + info + body
