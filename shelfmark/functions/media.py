"""Checks on item bytes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PNG_SIGNATURE = "89504E470D0A1A0A"
PNG_END = "49454E44AE426082"


def _hex(content: Column, start: int, length: int) -> Column:
    return F.hex(F.substring(content, start, length))


def _tail_hex(content: Column, length: int) -> Column:
    return F.hex(F.substring(content, -length, length))


def _big_endian(content: Column, start: int, length: int) -> Column:
    return F.conv(_hex(content, start, length), 16, 10).try_cast("bigint")


def is_png(content: Column) -> Column:
    return (_hex(content, 1, 8) == PNG_SIGNATURE) & (_hex(content, 13, 4) == "49484452")


def is_jpeg(content: Column) -> Column:
    return _hex(content, 1, 3) == "FFD8FF"


def is_webp(content: Column) -> Column:
    return (_hex(content, 1, 4) == "52494646") & (_hex(content, 9, 4) == "57454250")


def is_gif(content: Column) -> Column:
    return _hex(content, 1, 6).isin("474946383761", "474946383961")


def is_bmp(content: Column) -> Column:
    return _hex(content, 1, 2) == "424D"


def is_broken(content: Column | str) -> Column:
    """True when the bytes are no whole image: unknown magic or a missing end marker."""
    c = F.col(content) if isinstance(content, str) else content
    riff_size = F.conv(
        F.concat(_hex(c, 8, 1), _hex(c, 7, 1), _hex(c, 6, 1), _hex(c, 5, 1)), 16, 10
    ).try_cast("bigint")
    bmp_size = F.conv(
        F.concat(_hex(c, 6, 1), _hex(c, 5, 1), _hex(c, 4, 1), _hex(c, 3, 1)), 16, 10
    ).try_cast("bigint")
    whole = (
        F.when(is_png(c), _tail_hex(c, 8) == PNG_END)
        .when(is_jpeg(c), _tail_hex(c, 2) == "FFD9")
        .when(is_webp(c), F.octet_length(c) >= riff_size + 8)
        .when(is_gif(c), _tail_hex(c, 1) == "3B")
        .when(is_bmp(c), F.octet_length(c) >= bmp_size)
        .otherwise(F.lit(False))
    )
    return ~F.coalesce(whole, F.lit(False))


#: Segments of a JPEG that are walked in the JVM; images with more before their frame go on in Python.
SEGMENTS = 64
# Markers of a start of frame.
FRAMES = tuple(k for k in range(0xC0, 0xD0) if k not in (0xC4, 0xC8, 0xCC))


def _byte(content: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(content, at + 1, F.lit(1))), 16, 10).try_cast("int")


def _pair(content: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(content, at + 1, F.lit(2))), 16, 10).try_cast("int")


def jpeg_walk(content: Column) -> Column:
    """struct(at, open, width, height) after up to SEGMENTS segments; ``open`` tells that the walk is not over."""
    start = F.struct(F.lit(2).alias("at"), F.lit(True).alias("open"), F.lit(0).alias("width"), F.lit(0).alias("height"))

    def step(state: Column, _: Column) -> Column:
        at, kind = state["at"], _byte(content, state["at"] + 1)
        here = state["open"] & (at + 9 <= F.octet_length(content)) & (_byte(content, at) == 0xFF)
        frame = here & kind.isin(*FRAMES)
        after = F.when(kind == 0xFF, at + 1).otherwise(at + 2 + _pair(content, at + 2))
        return F.struct(
            F.when(here, after).otherwise(at).alias("at"), (here & ~frame).alias("open"),
            F.when(frame, _pair(content, at + 7)).otherwise(state["width"]).alias("width"),
            F.when(frame, _pair(content, at + 5)).otherwise(state["height"]).alias("height"),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(SEGMENTS)), start, step)


def jpeg_size(content: bytes) -> tuple[int, int]:
    """Width and height from the first start-of-frame segment of a JPEG, (0, 0) if there is none."""
    at, end = 2, len(content)
    while at + 9 <= end and content[at] == 0xFF:
        kind = content[at + 1]
        if kind == 0xFF:
            at += 1
        elif kind in FRAMES:
            height, width = content[at + 5 : at + 7], content[at + 7 : at + 9]
            return int.from_bytes(width, "big"), int.from_bytes(height, "big")
        else:
            at += 2 + int.from_bytes(content[at + 2 : at + 4], "big")
    return 0, 0


def _jpeg_sizes(content: pd.Series) -> pd.DataFrame:
    sizes = [jpeg_size(bytes(c)) if c is not None else (0, 0) for c in content]
    return pd.DataFrame(sizes, columns=["width", "height"])


def header_size(content: Column | str, with_jpeg: bool = True) -> Column:
    """struct(width, height) from the header bytes; (0, 0) when unreadable.

    All are read in the JVM. A JPEG needs a walk over its segments; the bytes of one go to Python only where that
    walk is not over after SEGMENTS of them. ``with_jpeg=False`` leaves JPEG out.
    """
    c = F.col(content) if isinstance(content, str) else content

    def pair(width: Column, height: Column) -> Column:
        return F.struct(
            F.coalesce(width, F.lit(0).cast("bigint")).alias("width"),
            F.coalesce(height, F.lit(0).cast("bigint")).alias("height"),
        )

    def little(*starts: int) -> Column:
        return F.conv(F.concat(*[_hex(c, s, 1) for s in starts]), 16, 10).try_cast("bigint")

    zero = F.lit(0).cast("bigint")
    png = pair(_big_endian(c, 17, 4), _big_endian(c, 21, 4))
    gif = pair(little(8, 7), little(10, 9))
    bmp = pair(little(22, 21, 20, 19), little(26, 25, 24, 23))
    vp8x = pair(little(27, 26, 25) + 1, little(30, 29, 28) + 1)
    lossy = pair(little(28, 27) % 16384, little(30, 29) % 16384)
    bits = little(25, 24, 23, 22)
    lossless = pair(bits % 16384 + 1, F.shiftright(bits, 14) % 16384 + 1)
    chunk = _hex(c, 13, 4)
    webp = (
        F.when(chunk == "56503858", vp8x)
        .when(chunk == "56503820", lossy)
        .when(chunk == "5650384C", lossless)
        .otherwise(pair(zero, zero))
    )
    sized = (
        F.when(is_png(c) & (F.octet_length(c) >= 24), png)
        .when(is_gif(c) & (F.octet_length(c) >= 10), gif)
        .when(is_bmp(c) & (F.octet_length(c) >= 26), bmp)
        .when(is_webp(c) & (F.octet_length(c) >= 30), webp)
    )
    if with_jpeg:
        found = jpeg_walk(c)
        rest = F.pandas_udf(_jpeg_sizes, "struct<width: bigint, height: bigint>")
        far = is_jpeg(c) & found["open"]
        sized = sized.when(far, rest(F.when(far, c)))
        sized = sized.when(is_jpeg(c), pair(found["width"].cast("bigint"), found["height"].cast("bigint")))
    return sized.otherwise(pair(zero, zero))
