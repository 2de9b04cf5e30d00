from martkit.sources.batches import frames


def test_frames_are_bounded_by_text():
    rows = [(i, "x" * 10) for i in range(10)] + [(10, None)]
    made = list(frames(iter(rows), ["page", "body"], limit=35))
    assert [len(frame) for frame in made] == [4, 4, 3]
    assert [page for frame in made for page in frame["page"]] == list(range(11))
    assert list(frames([], ["page", "body"])) == []
