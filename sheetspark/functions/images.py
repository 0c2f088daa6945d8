"""Image format, height and width from the bytes of image files.

All formats are read with built-in column expressions at the offsets the format
defines, so the bytes of an image never leave the JVM.  Bytes that are not a
complete image of a known format give null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# TIFF tags of the image size and the byte length of the integer types.
TIFF_WIDTH, TIFF_HEIGHT = 256, 257
TIFF_INTEGER_BYTES = {1: 1, 3: 2, 4: 4, 6: 1, 8: 2, 9: 4}

# JPEG frame markers are C0 to CF without these three.
JPEG_NOT_FRAMES = {0xC4, 0xC8, 0xCC}

JPEG_STEPS = 48  # segments walked in the first loop


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Compute a value once for an expression that uses it several times."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class _Bytes:
    """Integers at byte offsets of a binary column."""

    def __init__(self, content: Column) -> None:
        self.content = content

    def hex(self, offset: int | Column, length: int) -> Column:
        start = offset + 1 if isinstance(offset, Column) else F.lit(offset + 1)
        return F.hex(F.substring(self.content, start.cast("int"), F.lit(length)))

    def big(self, offset: int | Column, length: int) -> Column:
        return _number(self.hex(offset, length), length)

    def little(self, offset: int | Column, length: int) -> Column:
        text = self.hex(offset, length)
        swapped = F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(length))])
        return _number(swapped, length)

    def ordered(self, little: Column, offset: int | Column, length: int) -> Column:
        return F.when(little, self.little(offset, length)).otherwise(self.big(offset, length))


def _number(text: Column, length: int) -> Column:
    complete = F.length(text) == 2 * length
    return F.when(complete, F.conv(text, 16, 10).cast("bigint"))


def image_format(content: Column) -> Column:
    """The name of the image format, null if unknown."""
    data = _Bytes(content)
    size = F.octet_length(content)

    def starts(offset: int, *texts: str) -> Column:
        length = len(texts[0]) // 2
        return data.hex(offset, length).isin(*texts)

    png, ihdr = starts(1, "504E47"), starts(12, "49484452")
    tests = {
        "jpeg": (size >= 2) & starts(0, "FFD8"),
        "png": (size >= 24) & png & ihdr,
        "png-old": (size >= 16) & png,
        "gif": (size >= 10) & starts(0, "474946383761", "474946383961"),
        "jpeg2000": (size >= 12) & starts(0, "0000000C6A5020200D0A870A"),
        "bmp": (size >= 26) & starts(0, "424D"),
        "tiff": (size >= 8) & starts(0, "49492A00", "4D4D002A"),
        "ico": (size >= 8) & starts(0, "00000100"),
        "webp": (size >= 24) & starts(0, "52494646") & starts(8, "57454250"),
        "flif": (size >= 16) & starts(0, "464C4946"),
    }
    return F.coalesce(*[F.when(test, F.lit(name)) for name, test in tests.items()])


def image_size(content: Column, kind: Column | None = None) -> Column:
    """``struct(height, width)`` of an image; null when it cannot be read."""
    data = _Bytes(content)
    kind = image_format(content) if kind is None else kind
    sizes = {
        "jpeg": _jpeg(data, kind == "jpeg"),
        "png": _size(data.big(20, 4), data.big(16, 4)),
        "png-old": _size(data.big(12, 4), data.big(8, 4)),
        "gif": _size(data.little(8, 2), data.little(6, 2)),
        "jpeg2000": _size(data.big(48, 4), data.big(52, 4)),
        "bmp": _bmp(data),
        "tiff": _tiff(data),
        "ico": _size(_ico_side(data.big(7, 1)), _ico_side(data.big(6, 1))),
        "webp": _webp(data),
        "flif": _flif(data),
    }
    result = F.lit(None)
    for name, size in reversed(sizes.items()):
        result = F.when(kind == name, size).otherwise(result)
    return _let(
        result,
        lambda size: F.when(
            size.getField("height").isNotNull() & size.getField("width").isNotNull(), size
        ),
    )


def _size(height: Column, width: Column) -> Column:
    return F.struct(height.cast("int").alias("height"), width.cast("int").alias("width"))


def _signed(value: Column) -> Column:
    return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)


def _ico_side(side: Column) -> Column:
    return F.when(side == 0, 256).otherwise(side)


def _bmp(data: _Bytes) -> Column:
    def sizes(header: Column) -> Column:
        old = _size(data.little(20, 2), data.little(18, 2))
        # A negative height means the rows are stored from the top.
        new = _size(F.abs(_signed(data.little(22, 4))), _signed(data.little(18, 4)))
        return F.when(header == 12, old).when(header >= 40, new)

    return _let(data.little(14, 4), sizes)


def _tiff(data: _Bytes) -> Column:
    """Both sizes are integer entries of the first directory."""
    little = data.hex(0, 2) == "4949"

    def sizes(directory: Column) -> Column:
        count = data.ordered(little, directory, 2)
        indices = F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1))
        return _let(F.transform(indices, lambda i: entry(directory + 2 + i * 12)), tagged)

    def entry(at: Column) -> Column:
        kind = data.ordered(little, at + 2, 2)
        value = F.lit(None).cast("bigint")
        for code, length in TIFF_INTEGER_BYTES.items():
            value = F.when(kind == code, data.ordered(little, at + 8, length)).otherwise(value)
        return F.struct(data.ordered(little, at, 2).alias("tag"), value.alias("value"))

    def tagged(entries: Column) -> Column:
        def first(tag: int) -> Column:
            matches = F.filter(entries, lambda e: e.getField("tag") == tag)
            return F.get(matches, F.lit(0)).getField("value")

        return _size(first(TIFF_HEIGHT), first(TIFF_WIDTH))

    return _let(data.ordered(little, 4, 4), sizes)


def _webp(data: _Bytes) -> Column:
    chunk, low = data.hex(12, 4), F.lit(0x3FFF)
    lossless = _let(
        data.little(21, 4),
        lambda bits: _size(F.shiftright(bits, 14).bitwiseAND(low) + 1, bits.bitwiseAND(low) + 1),
    )
    lossy = _size(data.little(28, 2).bitwiseAND(low), data.little(26, 2).bitwiseAND(low))
    extended = _size(data.little(27, 3) + 1, data.little(24, 3) + 1)
    return (
        F.when(chunk == "5650384C", lossless)
        .when((chunk == "56503820") & (data.hex(23, 3) == "9D012A"), lossy)
        .when(chunk == "56503858", extended)
    )


def _flif(data: _Bytes) -> Column:
    """Width and height less one, as two numbers of seven bits per byte from byte 6 on."""
    values = F.transform(F.sequence(F.lit(6), F.lit(25)), lambda at: data.big(at, 1))
    start = F.struct(
        F.lit(0).alias("done"),
        F.lit(0).cast("bigint").alias("width"),
        F.lit(0).cast("bigint").alias("height"),
    )

    def step(state: Column, byte: Column) -> Column:
        done, last = state.getField("done"), byte < 128
        low = byte.bitwiseAND(F.lit(127))
        width, height = state.getField("width"), state.getField("height")
        return F.struct(
            (done + F.when((done < 2) & last, 1).otherwise(0)).alias("done"),
            F.when(done == 0, F.shiftleft(width, 7) + low).otherwise(width).alias("width"),
            F.when(done == 1, F.shiftleft(height, 7) + low).otherwise(height).alias("height"),
        )

    def finish(state: Column) -> Column:
        size = _size(state.getField("height") + 1, state.getField("width") + 1)
        return F.when(state.getField("done") == 2, size)

    known = F.filter(values, lambda byte: byte.isNotNull())
    return F.aggregate(known, start, step, finish)


def _jpeg(data: _Bytes, is_jpeg: Column) -> Column:
    """Walk the segments to the first frame header.

    Each step moves on by a byte at least, so as many steps as there are bytes
    always end the walk.  Almost every image needs only the first few; the others
    go on in two nested loops of the root of that number, which stop by themselves.
    """

    def state(at: Column, status: str, height: Column, width: Column) -> Column:
        return F.struct(
            at.cast("bigint").alias("at"),
            F.lit(status).alias("status"),
            height.cast("bigint").alias("height"),
            width.cast("bigint").alias("width"),
        )

    none = F.lit(None)
    frames = [f"FF{m:02X}" for m in range(0xC0, 0xD0) if m not in JPEG_NOT_FRAMES]

    def step(now: Column, _: Column) -> Column:
        at = now.getField("at")
        marker, length = data.hex(at, 2), data.big(at + 2, 2)
        return (
            F.when(now.getField("status") != "walking", now)
            .when((F.length(marker) < 4) | ~marker.startswith("FF"), state(at, "broken", none, none))
            .when(marker == "FFFF", state(at + 1, "walking", none, none))
            .when(marker.isin(frames), state(at, "found", data.big(at + 5, 2), data.big(at + 7, 2)))
            .when(length.isNull(), state(at, "broken", none, none))
            .otherwise(state(at + 2 + length, "walking", none, none))
        )

    def go_on(now: Column) -> Column:
        root = F.ceil(F.sqrt(F.octet_length(data.content))).cast("int")
        loop = F.sequence(F.lit(1), root)
        rest = F.aggregate(
            loop,
            now,
            lambda state, _: F.when(state.getField("status") != "walking", state).otherwise(
                F.aggregate(loop, state, step)
            ),
        )
        return F.when(now.getField("status") == "walking", rest).otherwise(now)

    start = state(F.lit(2), "walking", none, none)
    first = F.aggregate(F.sequence(F.lit(1), F.lit(JPEG_STEPS)), start, step)
    end = _let(F.when(is_jpeg, first), go_on)
    return _let(end, lambda now: _size(now.getField("height"), now.getField("width")))
