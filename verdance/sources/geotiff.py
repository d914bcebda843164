"""GeoTIFF reading and writing with numpy alone: strips or tiles; stored, deflate or LZW; any number of bands."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 8: 2, 9: 4, 11: 4, 12: 8, 16: 8}
CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
FORMATS = {1: "u", 2: "i", 3: "f"}


@dataclass
class Raster:
    """bands x rows x columns, the affine grid (a, b, c, d, e, f), EPSG code, nodata and band names."""

    data: np.ndarray
    grid: tuple[float, float, float, float, float, float] = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)
    crs: int | None = None
    nodata: float | None = None
    names: list[str] = field(default_factory=list)


def lzw(data: bytes) -> bytes:
    """Variable-width LZW, most significant bit first, as TIFF stores it."""
    out, table, width, bits, held, last = bytearray(), [], 9, 0, 0, None
    for byte in data:
        held, bits = held << 8 | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits
        held &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        entry = table[code] if code < len(table) else last + last[:1]
        out += entry
        if last is not None:
            table.append(last + entry[:1])
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        last = entry
    return bytes(out)


def tags(content: bytes) -> tuple[str, dict[int, tuple]]:
    """Byte order and the first image's tags."""
    order = {b"II": "<", b"MM": ">"}[content[:2]]
    magic, at = struct.unpack(order + "HI", content[2:8])
    if magic != 42:
        raise ValueError("not a classic TIFF")
    (n,) = struct.unpack_from(order + "H", content, at)
    out = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", content, at + 2 + 12 * i)
        place = at + 10 + 12 * i
        if SIZES.get(kind, 1) * count > 4:
            (place,) = struct.unpack_from(order + "I", content, place)
        if kind == 2:
            out[tag] = (content[place : place + count].rstrip(b"\0").decode("latin-1"),)
        elif kind in CODES:
            out[tag] = struct.unpack_from(f"{order}{count}{CODES[kind]}", content, place)
    return order, out


def header(content: bytes) -> dict:
    """width, height, bands, dtype, grid, crs, nodata of a file's bytes, without its pixels."""
    _, t = tags(content)
    bits, kind = t.get(258, (1,))[0], FORMATS.get(t.get(339, (1,))[0], "u")
    sx, sy = t.get(33550, (1.0, 1.0, 0.0))[:2]
    i, j, _, x, y, _ = t.get(33922, (0.0,) * 6)[:6]
    keys = t.get(34735, ())
    codes = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4)}
    nodata = t.get(42113, ("",))[0].strip()
    return {"width": t[256][0], "height": t[257][0], "bands": t.get(277, (1,))[0], "dtype": f"{kind}{bits // 8}", "grid": (sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy), "crs": codes.get(3072) or codes.get(2048), "nodata": float(nodata) if nodata else None}


def decode(content: bytes) -> Raster:
    order, t = tags(content)
    h = header(content)
    w, n, bands = h["width"], h["height"], h["bands"]
    dtype = np.dtype(order + h["dtype"])
    planar, packed, predictor = t.get(284, (1,))[0] == 2, t.get(259, (1,))[0], t.get(317, (1,))[0]
    tw, th = (t[322][0], t[323][0]) if 322 in t else (w, min(t.get(278, (n,))[0], n))
    places, sizes = (t[324], t[325]) if 322 in t else (t[273], t[279])
    across, down = -(-w // tw), -(-n // th)
    each = 1 if planar else bands
    out = np.zeros((bands, n, w), dtype.newbyteorder("="))
    for k, (at, size) in enumerate(zip(places, sizes)):
        raw = content[at : at + size]
        raw = {1: lambda b: b, 5: lzw, 8: zlib.decompress, 32946: zlib.decompress}[packed](raw)
        plane, block = divmod(k, across * down) if planar else (0, k)
        r, c = block // across * th, block % across * tw
        rows = th if 322 in t else min(th, n - r)
        a = np.frombuffer(raw, dtype, rows * tw * each).reshape(rows, tw, each)
        if predictor == 2:
            a = np.cumsum(a, axis=1, dtype=dtype)
        elif predictor != 1:
            raise ValueError(f"predictor {predictor} isn't read")
        part = a[: n - r, : w - c].transpose(2, 0, 1)
        (out[plane : plane + 1] if planar else out)[:, r : r + part.shape[1], c : c + part.shape[2]] = part
    return Raster(out, h["grid"], h["crs"], h["nodata"])


def encode(raster: Raster, compress: bool = True) -> bytes:
    """A little-endian TIFF, band by band, a strip a band."""
    data = np.ascontiguousarray(raster.data)
    bands, n, w = data.shape
    kind = {"u": 1, "i": 2, "f": 3}[data.dtype.kind]
    strips = [data[b].astype(data.dtype.newbyteorder("<")).tobytes() for b in range(bands)]
    strips = [zlib.compress(s) for s in strips] if compress else strips
    a, _, c, _, e, f = raster.grid
    entries: list[tuple[int, int, tuple]] = [
        (256, 4, (w,)), (257, 4, (n,)), (258, 3, (data.dtype.itemsize * 8,) * bands), (259, 3, (8 if compress else 1,)), (262, 3, (1,)), (273, 4, (0,) * bands),
        (277, 3, (bands,)), (278, 4, (n,)), (279, 4, tuple(map(len, strips))), (284, 3, (2,)), (339, 3, (kind,) * bands),
        (33550, 12, (a, -e, 0.0)), (33922, 12, (0.0, 0.0, 0.0, c, f, 0.0))]
    if raster.crs:
        projected = not 4000 <= raster.crs < 5000
        entries.append((34735, 3, (1, 1, 0, 2, 1024, 0, 1, 1 if projected else 2, 3072 if projected else 2048, 0, 1, raster.crs)))
    if raster.nodata is not None:
        entries.append((42113, 2, (f"{raster.nodata:g}".encode() + b"\0",)))
    entries.sort()
    pack = lambda k, v: v[0] if k == 2 else struct.pack(f"<{len(v)}{CODES[k]}", *v)
    base = 8 + 2 + 12 * len(entries) + 4
    extra = sum(len(p) + len(p) % 2 for _, k, v in entries if len(p := pack(k, v)) > 4)
    starts, at = [], base + extra
    for s in strips:
        starts.append(at)
        at += len(s)
    directory, tail = b"", b""
    for tag, k, v in entries:
        p = pack(k, tuple(starts) if tag == 273 else v)
        count = len(p) if k == 2 else len(v)
        if len(p) > 4:
            directory += struct.pack("<HHII", tag, k, count, base + len(tail))
            tail += p + b"\0" * (len(p) % 2)
        else:
            directory += struct.pack("<HHI", tag, k, count) + p.ljust(4, b"\0")
    return b"II" + struct.pack("<HIH", 42, 8, len(entries)) + directory + b"\0" * 4 + tail + b"".join(strips)


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    """raster_id (the path), length, width, height, bands, dtype, a..f, crs, nodata of every file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for p, size, content in zip(pdf["path"], pdf["length"], pdf["content"]):
                try:
                    h = header(bytes(content))
                    rows.append((p, size, h["width"], h["height"], h["bands"], h["dtype"], *h["grid"], h["crs"], h["nodata"]))
                except (ValueError, KeyError, struct.error):
                    rows.append((p, size, *[None] * 12))
            yield pd.DataFrame(rows, columns=["raster_id", "length", "width", "height", "bands", "dtype", *"abcdef", "crs", "nodata"]).astype({"width": "Int32", "height": "Int32", "bands": "Int32", "crs": "Int32"})

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "length", "content").mapInPandas(run, "raster_id string, length long, width int, height int, bands int, dtype string, a double, b double, c double, d double, e double, f double, crs int, nodata double")


def read_pixels(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """raster_id, row, col and a double column for each name; nodata and NaN are null. A file is decoded by one task, a stretch of rows at a time.

    Spark takes the packed files' bytes for the size of the cells; a join that must not broadcast them needs a hint.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for p, content in zip(pdf["path"], pdf["content"]):
                r = decode(bytes(content))
                bands, n, w = r.data.shape
                step = max(1, 200_000 // max(w, 1))
                for a in range(0, n, step):
                    part = r.data[:, a : a + step].astype(float)
                    bad = np.isnan(part) if r.nodata is None else np.isnan(part) | (part == r.nodata)
                    row, col = np.divmod(np.arange(part.shape[1] * w), max(w, 1))
                    out = {"raster_id": p, "row": (row + a).astype(np.int32), "col": col.astype(np.int32)}
                    for i, name in enumerate(names):
                        v = part[i].ravel() if i < bands else np.full(row.shape, np.nan)
                        out[name] = pd.array(v, "Float64")
                        out[name][bad[i].ravel() if i < bands else slice(None)] = pd.NA
                    yield pd.DataFrame(out)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(run, ", ".join(["raster_id string, row int, col int", *(f"`{c}` double" for c in names)]))


def encode_pixels(pixels: DataFrame, grid: tuple, crs: int | None, names: list[str], nodata: float = -32768.0, by: str = "raster_id") -> DataFrame:
    """raster_id, content: a float GeoTIFF of each raster's cells; a raster is one file, made by one task."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n, w = int(pdf["row"].max()) + 1, int(pdf["col"].max()) + 1
        data = np.full((len(names), n, w), nodata, np.float32)
        for i, c in enumerate(names):
            data[i, pdf["row"], pdf["col"]] = pdf[c].astype(float).fillna(nodata)
        return pd.DataFrame({by: [key[0]], "content": [encode(Raster(data, grid, crs, nodata))]})

    return pixels.select(by, "row", "col", *names).groupBy(by).applyInPandas(run, f"{by} string, content binary")


def write_files(files: DataFrame, folder: str, name: str = "raster_id") -> int:
    """Write (name, content) as <folder>/<name>.tif, each by the task that holds it, wherever pyarrow can write; returns how many."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        for pdf in batches:
            for n, content in zip(pdf[name], pdf["content"]):
                with store.open_output_stream(f"{root}/{n}.tif") as f:
                    f.write(content)
            yield pd.DataFrame({"n": [len(pdf)]})

    return files.select(name, "content").mapInPandas(run, "n long").agg({"n": "sum"}).first()[0] or 0
