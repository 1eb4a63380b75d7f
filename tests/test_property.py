"""Random appends and caps: every completed line arrives once, in order."""

import os
import tempfile

from hypothesis import given, settings, strategies as st

from tests.helpers import Tail, cfg, write

line = st.text(alphabet=st.sampled_from(list("ab\r é€😀")), max_size=30)


@settings(max_examples=60, deadline=None)
@given(
    pieces=st.lists(st.lists(line, max_size=6), min_size=1, max_size=6),
    tail=st.text(alphabet="xyz", max_size=5),
    cap=st.integers(min_value=1, max_value=64),
    split=st.integers(min_value=1, max_value=50),
)
def test_appends_read_once(pieces, tail, cap, split):
    d = tempfile.mkdtemp(prefix="appendlog-prop-")
    p = os.path.join(d, "f.log")
    write(p, b"")
    t = Tail(cfg(f"{d}/f\\.log", **{"bytes.max": cap, "split.bytes": split, "md5.sample.length": 8}))
    got, written = [], []
    for chunk in pieces:
        data = "".join(s + "\n" for s in chunk)
        written += chunk
        write(p, data.encode(), "ab")
        got += t.batch()
    got += t.drain()
    assert got == written
    write(p, tail.encode(), "ab")  # an unterminated tail is held, not emitted
    assert t.drain() == []
