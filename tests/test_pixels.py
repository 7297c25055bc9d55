import numpy as np

from inkloom.operators import pixels


def noise(h, w, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def test_phash_of_copies_and_of_noise():
    a = pixels.phash(noise(200, 200, 1))
    assert a == pixels.phash(noise(200, 200, 1))
    assert ((a ^ pixels.phash(noise(200, 200, 2))) & (2**64 - 1)).bit_count() > 6


def test_upscale():
    assert pixels.upscale(noise(100, 200), 150).shape[:2] == (150, 300)
    assert pixels.upscale(noise(100, 200), 100).shape[:2] == (100, 200)
    assert (pixels.upscale(np.full((10, 20, 3), 77, np.uint8), 30) == 77).all()


def test_masks():
    m = pixels.boxes_mask([(30, 40, 10, 20), (-5, -5, 3, 3), (9, 9, 9, 20)], 50, 60)
    assert m[20:40, 10:30].all() and m[:3, :3].all() and np.count_nonzero(m) == 400 + 9
    p = pixels.polygons_mask([[(10, 10), (20, 10), (20, 20), (10, 20)], [(1, 1), (2, 2)]], 40, 40)
    assert p[10:21, 10:21].all() and np.count_nonzero(p) == 121
    assert (pixels.union([m[:40, :40], p], 40, 40) >= p).all() and not pixels.union([], 4, 4).any()
    one = np.zeros((21, 21), np.uint8)
    one[10, 10] = 255
    grown = pixels.dilate(one, 3)
    assert grown[7, 10] and grown[10, 13] and not grown[7, 7] and (grown == grown[::-1]).all()
    assert (pixels.dilate(one, 0) == one).all()
    assert pixels.coverage(np.zeros((0, 0))) == 0.0


def test_letterbox_round_trip():
    image, mask = np.full((64, 48, 3), (10, 20, 30), np.uint8), np.zeros((64, 48), np.uint8)
    mask[5, 5], mask[6, 6] = 128, 127
    x, m, undo = pixels.letterbox(image, mask, 64, 64)
    assert x.shape == (1, 3, 64, 64) and m.shape == (1, 1, 64, 64) and m.sum() == 1
    assert np.allclose(x[0, :, 0, 0] * 255, (30, 20, 10))
    assert (pixels.unletterbox(x * 255.0, undo) == image).all()
    out = pixels.composite(image, np.zeros_like(image), mask)
    assert not out[5, 5].any() and (out[6, 6] == image[6, 6]).all()


def test_tagger_input():
    x = pixels.tagger_input(np.zeros((10, 20, 3), np.uint8), 20)
    assert x.shape == (1, 20, 20, 3) and x[0, 0, 0, 0] == 255 and x[0, 10, 10, 0] == 0


def test_cut_by_gutters():
    page = np.full((100, 100), 255, np.uint8)
    for y in (0, 60):
        for x in (0, 60):
            page[y : y + 40, x : x + 40] = 40
    got = pixels.cut_by_gutters(page, (0, 0, 100, 100), min_run=5, min_side=10)
    assert sorted(got) == [(0, 0, 40, 40), (0, 60, 40, 40), (60, 0, 40, 40), (60, 60, 40, 40)]
    assert pixels.cut_by_gutters(np.zeros((50, 50), np.uint8), (0, 0, 50, 50)) == [(0, 0, 50, 50)]


def test_outer_boxes():
    ink = np.zeros((30, 30), bool)
    ink[2:20, 2] = ink[2:20, 19] = ink[2, 2:20] = ink[19, 2:20] = True
    ink[8:10, 8:10] = True  # in the hole of the frame
    ink[20, 20] = True  # touches the frame's corner
    ink[25, 25] = True
    assert sorted(pixels.outer_boxes(ink)) == [(2, 2, 19, 19), (25, 25, 1, 1)]
    assert pixels.outer_boxes(np.ones((3, 3), bool)) == [(0, 0, 3, 3)]
