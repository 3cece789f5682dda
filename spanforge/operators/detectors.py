"""Face detectors for ``visual.detect_faces``: a neural one with its files, and a cascade as its fallback.

Both need OpenCV, which is imported where a worker makes its detector; the neural one needs its two model files as well.
A detector takes an encoded frame and returns height, width and boxes (x1, y1, x2, y2, confidence) in pixels, or None.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np

from .. import config as C

Detector = Callable[[bytes], tuple[int, int, list[tuple[float, ...]]] | None]

#: Input side and channel means of the neural detector, file names of its model, settings of the cascade.
SIDE, MEANS = 300, (104.0, 177.0, 123.0)
NETWORK_FILES = ("deploy.prototxt", "res10_300x300_ssd_iter_140000.caffemodel")
CASCADE_FILE, CASCADE = "haarcascade_frontalface_default.xml", {"scaleFactor": 1.1, "minNeighbors": 5, "minSize": (60, 60)}


def boxes_in_pixels(found: np.ndarray, height: int, width: int) -> list[tuple[float, ...]]:
    """Boxes of rows (.., confidence, x1, y1, x2, y2) with relative corners: the confident ones, held inside the frame, in pixels."""
    rows = found.reshape(-1, found.shape[-1])[:, -5:].astype(np.float64)
    rows = rows[rows[:, 0] >= C.MIN_FACE_CONFIDENCE]
    low, high = np.maximum(rows[:, 1:3], 0), np.minimum(rows[:, 3:5], 1)
    corners = np.concatenate([low, high], 1) * [width, height, width, height]
    return [(*map(float, c), float(p)) for c, p in zip(corners, rows[:, 0], strict=True)]


def network(folder: str | None = None) -> Callable[[], Detector]:
    """A loader of the neural detector, which fails where its files are missing."""

    def load() -> Detector:
        import cv2

        paths = [os.path.join(folder or os.path.join(os.path.dirname(cv2.__file__), "data"), f) for f in NETWORK_FILES]
        if missing := [p for p in paths if not os.path.exists(p)]:
            raise FileNotFoundError(missing[0])
        net = cv2.dnn.readNetFromCaffe(*paths)

        def detect(content: bytes):
            frame = cv2.imdecode(np.frombuffer(content, np.uint8), cv2.IMREAD_COLOR)
            if frame is None:
                return None
            net.setInput(cv2.dnn.blobFromImage(cv2.resize(frame, (SIDE, SIDE)), 1.0, (SIDE, SIDE), MEANS))
            height, width = frame.shape[:2]
            return height, width, boxes_in_pixels(net.forward(), height, width)

        return detect

    return load


def cascade() -> Detector:
    """The fallback: its boxes count as certain."""
    import cv2

    finder = cv2.CascadeClassifier(os.path.join(cv2.data.haarcascades, CASCADE_FILE))

    def detect(content: bytes):
        frame = cv2.imdecode(np.frombuffer(content, np.uint8), cv2.IMREAD_GRAYSCALE)
        if frame is None:
            return None
        found = finder.detectMultiScale(frame, **CASCADE)
        return *frame.shape[:2], [(float(x), float(y), float(x + w), float(y + h), 1.0) for x, y, w, h in found]

    return detect
