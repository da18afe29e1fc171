import base64
import re
import struct

import pytest

from docloom.sources import formats, samples
from docloom.sources.compound import Compound
from docloom.sources.parsers import parse, set_bridge

WORDS = [f"Word{i}" for i in range(1, 36)]


@pytest.mark.parametrize("ext", sorted(samples.WRITERS))
def test_round_trip_of_each_written_format(ext):
    name = "x.txt.gz" if ext == ".gz" else f"x{ext}"
    text, quality, reason = parse(name, samples.write(ext, WORDS))
    assert reason is None and quality > 0
    assert [w for w in re.findall(r"\w+", text) if w.startswith("Word")] == WORDS


@pytest.mark.parametrize("ext", [".pdf", ".doc", ".xls", ".msg", ".vsdx", ".dxf", ".stl", ".psd", ".pcap", ".pcapng", ".cer", ".jpg", ".ai"])
@pytest.mark.parametrize("content", [b"", b"\0" * 100, b"%PDF-1.4 stream", b"0\nSECTION\n2", bytes.fromhex("d0cf11e0a1b11ae1") + b"\xff" * 700, b"8BPS" + b"\xff" * 40])
def test_broken_files_keep_their_row(ext, content):
    text, quality, reason = parse(f"a{ext}", content)
    assert (text == "" and reason) or (text and reason is None)


def test_pdf_maps_hexadecimal_codes_and_joins_kerned_parts():
    cmap = b"begincmap 2 beginbfchar <0001> <0048> <0002> <0069> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange endcmap"
    page = b"BT <00010002> Tj 0 -12 Td [(wi) -30 (de) -400 (gap)] TJ T* <001000110012> Tj ET"
    pdf = b"%PDF\n" + b"".join(b"<< /Length %d >>\nstream\n%s\nendstream\n" % (len(s), s) for s in (cmap, page))
    assert formats.pdf_text("a.pdf", pdf) == "Hi\nwide gap\nabc"


def test_ladder_goes_on_only_while_little_was_found_and_keeps_the_longer():
    asked = []
    step = lambda text: lambda name, content: asked.append(text) or text
    old = formats.STEPS["image"][:]
    try:
        formats.STEPS["image"][:] = []
        for q, t in ((0.8, "short"), (0.8, "tiny"), (0.7, "a text of more than twenty characters"), (0.6, "never asked")):
            formats.add_step("image", step(t), q)
        assert formats.ladder("image", "a.png", b"")[0].startswith("a text") and asked == ["short", "tiny", "a text of more than twenty characters"]
        assert parse("a.png", b"x")[:2] == ("a text of more than twenty characters", 0.7)
    finally:
        formats.STEPS["image"][:] = old
    assert parse("a.png", b"xy")[0] == "[IMAGE_METADATA]\nFile: a.png\nType: .png\nSize: 2"


def test_bridge_modes():
    other = lambda name, content: ("bridged", 0.9)
    try:
        set_bridge(other, "prefer")
        assert parse("a.txt", b"own text")[0] == "bridged"
        set_bridge(other, "fallback")
        assert parse("a.txt", b"own text")[0] == "own text" and parse("a.evtx", b"")[0] == "bridged"
        with pytest.raises(ValueError, match="mode"):
            set_bridge(other, "always")
    finally:
        set_bridge(None)
    assert parse("a.evtx", b"")[2] == "library_missing"


def test_compound_streams_of_many_sectors():
    data = {"Big": bytes(range(256)) * 400, "Small": b"abc"}
    f = Compound(samples.compound(data))
    assert f.read("Big") == data["Big"] and f.read("Small").rstrip(b"\0") == b"abc"


def test_mesh_card():
    corners = [(0, 0, 0), (0, 2, 0), (1, 0, 0)], [(0, 0, 0), (1, 0, 0), (0, 0, 3)], [(0, 0, 0), (0, 0, 3), (0, 2, 0)], [(1, 0, 0), (0, 2, 0), (0, 0, 3)]
    raw = b"\0" * 80 + struct.pack("<I", 4) + b"".join(struct.pack("<12fH", 0, 0, 0, *(x for c in t for x in c), 0) for t in corners)
    text, quality, _ = parse("m.stl", raw)
    assert "Triangles: 4" in text and "Vertices: 12" in text and "Y: 0.000 to 2.000" in text and "Volume: 1.000" in text and quality == 0.7
    ascii_ = "solid m\n" + "".join("facet\n" + "".join(f"vertex {x} {y} {z}\n" for x, y, z in t) + "endfacet\n" for t in corners)
    assert parse("m.stl", ascii_.encode())[0] == text


def _frame(proto, a, b):
    return b"\1" * 6 + b"\2" * 6 + b"\x08\x00" + bytes([0x45, 0, 0, 20, 0, 0, 0, 0, 64, proto, 0, 0, *a, *b])


def test_captures_of_both_layouts():
    frames = [_frame(6, (10, 0, 0, 1), (10, 0, 0, 2))] * 3 + [_frame(17, (10, 0, 0, 3), (10, 0, 0, 2))]
    old = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 65535, 1) + b"".join(struct.pack("<IIII", 100 + k, 0, len(f), len(f)) + f for k, f in enumerate(frames))
    block = lambda kind, body: struct.pack("<II", kind, len(body) + 12) + body + struct.pack("<I", len(body) + 12)
    pad = lambda f: f + b"\0" * (-len(f) % 4)
    new = block(0x0A0D0D0A, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1)) + b"".join(block(6, struct.pack("<IIIII", 0, 0, (100 + k) * 1_000_000, len(f), len(f)) + pad(f)) for k, f in enumerate(frames))
    for ext, raw in ((".pcap", old), (".pcapng", new)):
        text, quality, _ = parse(f"c{ext}", raw)
        assert "Packets: 4\nTime: 1970-01-01 00:01:40 to 1970-01-01 00:01:43\nProtocols: TCP=3, UDP=1\nSources: 10.0.0.1=3, 10.0.0.3=1\nDestinations: 10.0.0.2=4" in text
        assert quality == 0.4


def _der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


def test_certificate_card():
    oid = lambda *xs: _der(6, bytes(xs))
    name = lambda cn: _der(0x30, _der(0x31, _der(0x30, oid(0x55, 4, 3), _der(0x0C, cn))))
    algorithm = _der(0x30, oid(0x2A, 0x86, 0x48, 0x86, 0xF7, 0x0D, 1, 1, 0x0B))
    san = _der(0x30, oid(0x55, 0x1D, 0x11), _der(4, _der(0x30, _der(0x82, b"a.example"), _der(0x82, b"b.example"))))
    body = _der(0x30, _der(0xA0, _der(2, b"\2")), _der(2, b"\x01\x02"), algorithm, name(b"Issuer"), _der(0x30, _der(0x17, b"250102030405Z"), _der(0x18, b"20510102030405Z")), name(b"Subject"), _der(0x30), _der(0xA3, _der(0x30, san)))
    der = _der(0x30, body, algorithm, _der(3, b"\0"))
    want = "Certificate: c.cer\nSubject: CN=Subject\nIssuer: CN=Issuer\nSerial: 258\nValid: 2025-01-02 03:04:05 to 2051-01-02 03:04:05\nSignature: 1.2.840.113549.1.1.11\nVersion: 3\nDNS names: a.example, b.example"
    assert parse("c.cer", der)[:2] == (want, 0.8)
    assert parse("c.cer", b"-----BEGIN CERTIFICATE-----\n" + base64.b64encode(der) + b"\n-----END CERTIFICATE-----")[0] == want


def test_layered_image_card():
    name = b"\x04Back\0\0\0"
    luni = b"8BIMluni" + struct.pack(">II", 12, 4) + "Tops".encode("utf-16-be")
    extra = struct.pack(">II", 0, 0) + name + luni
    layer = b"\0" * 16 + struct.pack(">H", 1) + b"\0" * 6 + b"8BIMnorm\0\0\0\0" + struct.pack(">I", len(extra)) + extra
    info = struct.pack(">h", 1) + layer
    raw = b"8BPS" + struct.pack(">H", 1) + b"\0" * 6 + struct.pack(">HIIHH", 3, 40, 60, 8, 3) + struct.pack(">II", 0, 0) + struct.pack(">II", len(info) + 4, len(info)) + info + b"Txt TEXT" + struct.pack(">I", 2) + "Hi".encode("utf-16-be")
    assert parse("p.psd", raw)[:2] == ("PSD: p.psd\nSize: 60 x 40\nMode: RGB, 8 bits\nLayers: 1\n- Tops\nText: Hi", 0.8)


def test_drawing_layers_and_blocks():
    pairs = [(0, "SECTION"), (2, "TABLES"), (0, "LAYER"), (2, "Walls"), (0, "ENDSEC"), (0, "SECTION"), (2, "BLOCKS"), (0, "BLOCK"), (2, "*U1"), (0, "TEXT"), (1, "hidden"), (0, "BLOCK"), (2, "Frame"), (0, "TEXT"), (1, "title"), (0, "ENDSEC"), (0, "SECTION"), (2, "ENTITIES"), (0, "MTEXT"), (3, "first "), (1, "{\\fArial;second}\\Pline"), (0, "DIMENSION"), (1, "<>"), (0, "ENDSEC"), (0, "EOF")]
    text, quality, _ = parse("d.dxf", "\n".join(f"{a}\n{b}" for a, b in pairs).encode())
    assert text == "DXF: d.dxf\n\nLayers: Walls\n\nfirst second\nline\n\ntitle" and quality == 0.5
