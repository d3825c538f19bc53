"""Messages of the velocity stream to its state store."""

from types import SimpleNamespace

from tests import test_streaming


def test_the_timer_of_an_account_is_known_without_asking():
    from txnlake.streaming.velocity import WatermarkedWindowProcessor

    class Handle(test_streaming._Handle):
        def listTimers(self):
            raise AssertionError("a message to the state store")

    handle, rows = Handle(), sorted(test_streaming._events(60, 1, seed=2, ordered=True, span_s=900))
    processor = WatermarkedWindowProcessor(300)
    processor.init(handle)
    times = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    for at in range(0, 60, 20):
        list(processor.handleInputRows(("A",), iter([test_streaming._frame(rows[at:at + 20])]), times))
        latest = max(v[3] for v in handle.maps["window"].values())
        assert handle.timers == [(latest + 300_000_000) // 1000 + 1]
