import numpy as np
import pytest

from loamworks.llm import webp

RNG = np.random.default_rng(7)


def picture(h, w, colours=None):
    p = RNG.integers(0, 1 << 32, (h, w), dtype=np.uint64).astype(np.uint32)
    smooth = (np.add.outer(np.arange(h), np.arange(w)) * 0x010203).astype(np.uint32) | np.uint32(0xFF000000)
    p = np.where(RNG.random((h, w)) < 0.3, p, smooth)
    if colours:
        p = RNG.integers(0, 1 << 32, colours, dtype=np.uint64).astype(np.uint32)[RNG.integers(0, colours, (h, w))]
    return p


@pytest.mark.parametrize("h,w", [(1, 1), (1, 9), (7, 1), (13, 21), (40, 33)])
@pytest.mark.parametrize("cache", [0, 3, 11])
def test_plain_and_cached_pictures_come_back(h, w, cache):
    p = picture(h, w)
    assert (webp.decode_picture(webp.encode_picture(p, (), cache)) == p).all()


@pytest.mark.parametrize("mode", range(14))
def test_each_predictor_is_inverted(mode):
    p = picture(23, 19)
    modes = np.full((6, 5), mode)
    assert (webp.decode_picture(webp.encode_picture(p, ((webp.PREDICTOR, modes, 2),))) == p).all()


def test_all_transforms_in_a_row():
    p = picture(37, 29)
    modes = RNG.integers(0, 14, (5, 4))
    elements = picture(10, 8) | np.uint32(0xFF000000)
    steps = ((webp.PREDICTOR, modes, 3), (webp.CROSS_COLOUR, elements, 2), (webp.SUBTRACT_GREEN,))
    assert (webp.decode_picture(webp.encode_picture(p, steps, 5)) == p).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 5, 16, 17, 200])
def test_palettes_and_bundles(colours):
    p = picture(11, 23, colours)
    assert (webp.decode_picture(webp.encode_picture(p, ((webp.PALETTE,),))) == p).all()


def test_code_lengths_are_limited_and_complete():
    counts = np.array([2**k for k in range(30)])
    n = webp.code_lengths(counts)
    assert n.max() <= 15 and sum(2.0 ** -n.astype(float)) == 1


@pytest.mark.parametrize(
    "text",
    [b"", b"a", b"x" * 64, b"x" * 65, bytes(range(256)) * 3, b"Und " * 5000, "née 🎉 ".encode() * 999, bytes(RNG.integers(0, 256, 300_000, dtype=np.uint8))],
)
def test_payloads_round_trip(text):
    payload = webp.padded(text)
    assert len(payload) % 64 == 0 and len(payload) >= 64
    media = webp.store(payload)
    assert webp.load(media) == payload
    assert media == webp.store(payload)


def test_one_channel_path_equals_the_general_path():
    text = webp.padded(b"to be or not to be, that is the question. " * 40 + b"\0" * 500)
    media = webp.store(text)
    fast = webp.load(media)
    whole = webp._one_channel
    webp._one_channel = lambda bits, group, width, total: general(bits, group, width, total)
    try:
        assert webp.load(media) == fast == text
    finally:
        webp._one_channel = whole


def general(bits, group, width, total):
    out, put = np.zeros(total, np.uint32), 0
    while put < total:
        s = group[0].read(bits)
        if s < 256:
            out[put] = 0xFF000000 | s << 8
            put += 1
        else:
            n = webp._value(bits, s - 256)
            webp._copy(out, put, webp._distance(webp._value(bits, group[4].read(bits)), width), n)
            put += n
    return out


def test_a_broken_file_is_refused():
    with pytest.raises(ValueError):
        list(webp.pictures(b"GIF89a" + b"\0" * 60))


def test_store_chooses_transforms_and_far_references():
    r = np.random.default_rng(5)
    smooth = (np.cumsum(r.integers(-2, 3, 64 * 60)) & 255).astype(np.uint8).tobytes()
    noise = r.integers(0, 256, 64 * 20, np.uint8).tobytes()
    far = noise + r.integers(0, 256, 64 * 3 + 64, np.uint8).tobytes() + noise[5:] + noise[:5]
    for payload, most in ((smooth, 0.5), (far, 0.7)):
        media = webp.store(payload)
        assert webp.load(media) == payload and len(media) < most * len(payload)
    kinds = [[x[0] for x in webp.chosen_steps(np.frombuffer(p, np.uint8).reshape(-1, 64))] for p in (smooth, far, b"ab" * 64)]
    assert kinds == [[webp.PREDICTOR], [], [webp.PALETTE]]


@pytest.mark.parametrize("distance", [2, 63, 64, 65, 121, 5000, 70_000, 120_000])
def test_references_at_any_distance(distance):
    r = np.random.default_rng(distance)
    first = r.integers(0, 256, distance, np.uint8).tobytes()
    payload = (first * (200 // distance + 2))[: distance + 5000]
    payload += b"\0" * (-len(payload) % 64)
    media = webp.store(payload)
    assert webp.load(media) == payload and len(media) < distance + 1500
