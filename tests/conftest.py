import os
import struct
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from terrasift.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[8]", shuffle_partitions=8,
        checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        extra={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
               "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def png(width, height, pixel):
    """Bytes of an RGB PNG; ``pixel(x, y)`` gives the colour."""
    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    rows = b"".join(b"\0" + b"".join(bytes(pixel(x, y)) for x in range(width)) for y in range(height))
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b""))


@pytest.fixture
def image_tree(tmp_path):
    """Three pictures in class directories, one broken file and one other file."""
    for name, picture in (("Cyclone/a.png", png(8, 6, lambda x, y: (0, 50, 100))),
                          ("Flood/b.png", png(10, 10, lambda x, y: (20 * x, 10 * y, 7))),
                          ("Flood/c.png", png(10, 10, lambda x, y: (255, 255, 255))),
                          ("Flood/bad.jpg", b"this is not a picture"), ("Flood/notes.txt", b"text")):
        target = tmp_path / "tree" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(picture)
    return str(tmp_path / "tree")
