"""Text and pictures of PDF files, read with the standard library alone.

Covers what most writers produce: plain and Flate-compressed streams, object streams, simple and composite fonts with a
ToUnicode table, JPEG pictures. Encrypted files and other filters give no text.
"""

from __future__ import annotations

import re
import zlib

_OBJECT = re.compile(rb"(\d+)\s+(\d+)\s+obj\b(.*?)\bendobj", re.S)
_STREAM = re.compile(rb"^(.*?)\bstream\r?\n(.*?)(?:\r?\n)?endstream", re.S)
_REF = re.compile(rb"(\d+)\s+\d+\s+R")
_SHOW = re.compile(
    rb"\[((?:\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[^<>]*>|[^\]()<>])*)\]\s*TJ"  # an array of strings and gaps
    rb"|(\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>)\s*(Tj|'|\")"  # one string
    rb"|/(\S+)\s+[-\d.]+\s+Tf|\b(T\*|ET)(?![A-Za-z])|([-\d.]+)\s+([-\d.]+)\s+(T[dD])\b|(?:[-\d.]+\s+){4}[-\d.]+\s+([-\d.]+)\s+Tm\b",
    re.S,
)
_PART = re.compile(rb"\((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*\)|<[0-9A-Fa-f\s]*>|-?\d+(?:\.\d+)?", re.S)
_ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def _objects(raw: bytes) -> dict[int, bytes]:
    """The body of every object, those packed in object streams included."""
    found = {int(m.group(1)): m.group(3) for m in _OBJECT.finditer(raw)}
    for body in list(found.values()):
        if b"/ObjStm" in body:
            first, count = (int(re.search(rb"/%s\s+(\d+)" % key, body).group(1)) for key in (b"First", b"N"))
            data = _data(body)
            numbers = [int(x) for x in data[:first].split()[: 2 * count]]
            places = numbers[1::2]
            for number, a, b in zip(numbers[::2], places, [*places[1:], len(data) - first]):
                found.setdefault(number, data[first + a : first + b])
    return found


def _data(body: bytes) -> bytes:
    match = _STREAM.match(body)
    if not match:
        return b""
    if b"/FlateDecode" in match.group(1):
        return zlib.decompressobj().decompress(match.group(2))
    return match.group(2)


def _pages(objects: dict[int, bytes]) -> list[int]:
    """Page objects in order of the page tree; in order of their numbers where the tree cannot be followed."""
    kinds = {n: re.search(rb"/Type\s*/(Pages|Page)\b", body) for n, body in objects.items()}
    kids = {n: [int(x) for x in _REF.findall(m.group(1))] for n, body in objects.items() if kinds[n] and (m := re.search(rb"/Kids\s*\[(.*?)\]", body, re.S))}
    below = {k for own in kids.values() for k in own}
    order: list[int] = []
    stack = [n for n in sorted(kids, reverse=True) if n not in below]
    seen = set()
    while stack:
        at = stack.pop()
        if at in seen:
            continue
        seen.add(at)
        if at in kids:
            stack += reversed(kids[at])
        elif kinds.get(at):
            order.append(at)
    return order or sorted(n for n, k in kinds.items() if k and k.group(1) == b"Page")


def _unicode_table(data: bytes) -> tuple[int, dict[int, str]]:
    """(bytes of a code, text of each code) of a ToUnicode table."""
    out: dict[int, str] = {}
    width = 1
    text = lambda h: bytes.fromhex(h.decode()).decode("utf-16-be", "replace")
    for block in re.findall(rb"beginbfchar(.*?)endbfchar", data, re.S):
        for code, target in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            width = len(code) // 2
            out[int(code, 16)] = text(target)
    for block in re.findall(rb"beginbfrange(.*?)endbfrange", data, re.S):
        for low, high, target in re.findall(rb"<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>\s*<([0-9A-Fa-f]+)>", block):
            width, start = len(low) // 2, text(target)
            for k in range(min(int(high, 16) - int(low, 16), 0xFFFF) + 1):
                out[int(low, 16) + k] = start[:-1] + chr(ord(start[-1]) + k) if start else ""
    return width, out


def _string(part: bytes, font: tuple[int, dict[int, str]] | None) -> str:
    if part[:1] == b"<":
        digits = re.sub(rb"\s", b"", part[1:-1])
        raw = bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    else:
        raw = re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda m: bytes([int(m.group(1), 8) & 255]) if m.group(1).isdigit() else b"" if m.group(1)[-1:] == b"\n" else _ESCAPES.get(m.group(1), m.group(1)), part[1:-1], flags=re.S)
    if font and font[1]:
        width, table = font
        return "".join(table.get(int.from_bytes(raw[k : k + width], "big"), "") for k in range(0, len(raw), width))
    return raw.decode("cp1252", "replace")


def _page_text(content: bytes, fonts: dict[bytes, tuple[int, dict[int, str]]]) -> str:
    out: list[str] = []
    font, height = None, None

    def newline() -> None:
        if out and not out[-1].endswith("\n"):
            out.append("\n")

    for m in _SHOW.finditer(content):
        array, one, shown, name, over, _, down, _, line = m.groups()
        if name:
            font = fonts.get(name)
        elif over or (down and float(down) != 0):
            newline()
        elif line is not None:
            if height is not None and line != height:
                newline()
            height = line
        elif one is not None:
            if shown in (b"'", b'"'):
                newline()
            out.append(_string(one, font))
        elif array is not None:
            for part in _PART.findall(m.group(0)[1:]):
                if part[:1] in (b"(", b"<"):
                    out.append(_string(part, font))
                elif float(part) < -200 and out and not out[-1].endswith((" ", "\n")):
                    out.append(" ")
    return "".join(out).strip("\n")


def _entry(body: bytes, key: bytes, objects: dict[int, bytes]) -> bytes:
    """The value of a key: of a dictionary in place, or of the object it refers to."""
    match = re.search(rb"/%s\s*(?:(\d+)\s+\d+\s+R|(<<(?:[^<>]|<<(?:[^<>]|<<[^<>]*>>|<[^<>]*>)*>>|<[^<>]*>)*>>|\[[^\]]*\]))" % key, body, re.S)
    if not match:
        return b""
    return objects.get(int(match.group(1)), b"") if match.group(1) else match.group(2)


def read_pdf(raw: bytes) -> tuple[list[str], list[tuple[int, int, bytes, str]]]:
    """(text of every page, pictures as (page, place on the page, bytes, extension)); pages count from 1."""
    objects = _objects(raw)
    texts, pictures = [], []
    for number, at in enumerate(_pages(objects), 1):
        body = objects[at]
        resources = _entry(body, b"Resources", objects)
        fonts = {}
        for name, ref in re.findall(rb"/(\S+)\s+(\d+)\s+\d+\s+R", _entry(resources, b"Font", objects)):
            table = re.search(rb"/ToUnicode\s+(\d+)\s+\d+\s+R", objects.get(int(ref), b""))
            fonts[name] = _unicode_table(_data(objects.get(int(table.group(1)), b""))) if table else (1, {})
        contents = re.search(rb"/Contents\s*(\[.*?\]|\d+\s+\d+\s+R)", body, re.S)
        parts = [_data(objects.get(int(x), b"")) for x in _REF.findall(contents.group(1))] if contents else []
        texts.append(_page_text(b"\n".join(parts), fonts))
        shown = [objects.get(int(ref), b"") for _, ref in re.findall(rb"/(\S+)\s+(\d+)\s+\d+\s+R", _entry(resources, b"XObject", objects))]
        for place, picture in enumerate(x for x in shown if re.search(rb"/Subtype\s*/Image\b", x)):
            pictures.append((number, place, _data(picture), ".jpg" if b"/DCTDecode" in picture else ".bin"))
    return texts, pictures
