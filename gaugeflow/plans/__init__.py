"""Models and dashboard queries as plans over a telemetry store.

Every plan is a function ``(store, as_of_ms, window_ms, ...) -> DataFrame``. ``as_of_ms``
defaults to the present; a window keeps rows at or after ``as_of_ms - window_ms`` and has
no upper end.
"""
