"""Logging: a logger whose file is rotated, printed text as records, and the time that stages take."""

from __future__ import annotations

import contextlib
import io
import logging
import logging.handlers
import time
from collections.abc import Callable, Iterator

FORMAT = "%(asctime)s %(levelname)s %(message)s"


def logger(file: str | None = None, level: int = logging.INFO, most_bytes: int = 10_000_000, old_files: int = 5, daily: bool = False) -> logging.Logger:
    """The package's logger. With a file, records go there too; a full file is put
    aside, or (daily) each day's at midnight."""
    log = logging.getLogger("emberlane")
    log.setLevel(level)
    if file and not any(getattr(h, "baseFilename", None) for h in log.handlers):
        if daily:
            handler: logging.Handler = logging.handlers.TimedRotatingFileHandler(file, when="midnight", backupCount=old_files, delay=True)
        else:
            handler = logging.handlers.RotatingFileHandler(file, maxBytes=most_bytes, backupCount=old_files, delay=True)
        handler.setFormatter(logging.Formatter(FORMAT))
        log.addHandler(handler)
    return log


class Recorder(io.TextIOBase):
    """A text stream that hands on each line once it is complete, and the last one when it is closed."""

    def __init__(self, emit: Callable[[str], None]):
        super().__init__()
        self._emit, self._open = emit, ""

    def writable(self) -> bool:
        return True

    def write(self, text: str) -> int:
        *complete, self._open = (self._open + text).split("\n")
        for one in complete:
            if one.strip():
                self._emit(one)
        return len(text)

    def close(self) -> None:
        if not self.closed:
            self.write("\n")
        super().close()


@contextlib.contextmanager
def recorded(log: logging.Logger) -> Iterator[None]:
    """Inside, what is printed becomes records at INFO, and what goes to stderr at WARNING."""
    with contextlib.ExitStack() as stack:
        out = stack.enter_context(contextlib.closing(Recorder(log.info)))
        err = stack.enter_context(contextlib.closing(Recorder(log.warning)))
        stack.enter_context(contextlib.redirect_stdout(out))
        stack.enter_context(contextlib.redirect_stderr(err))
        yield


@contextlib.contextmanager
def stage(log: logging.Logger, name: str) -> Iterator[None]:
    """Records when a stage begins, and after how many seconds it ends or fails."""
    begun = time.monotonic()
    log.info("%s: begins", name)
    try:
        yield
    except BaseException:
        log.exception("%s: failed after %.1f s", name, time.monotonic() - begun)
        raise
    log.info("%s: done after %.1f s", name, time.monotonic() - begun)
