import pytest

from tablelab.llm import packed


@pytest.mark.parametrize("total", [10**6, 5 * 10**8, 3 * 10**10, 3 * 10**12, 10**14])
def test_a_row_holds_enough_hashes_at_any_size(total):
    group, bucket = packed.sizes(total, packed.GROUP_BYTES, packed.BUCKET_BYTES)
    buckets = 1 << max(1, int(total // bucket).bit_length())  # as many as bits name
    words = min(group, total) / packed.HASH_BYTES
    assert words / buckets >= packed.ROW_HASHES - 1
    assert group >= packed.GROUP_BYTES and bucket >= packed.BUCKET_BYTES
    assert max(group, bucket) <= 300 << 20
    if total <= 3 * 10**10:
        assert (group, bucket) == (packed.GROUP_BYTES, packed.BUCKET_BYTES)
