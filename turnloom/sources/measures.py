"""Measures and filters of recordings that take samples block by block: what they hold does not grow with a recording's samples.

Frame levels come from sums of squares of hops, of which a frame is a sliding sum; filters and resamplers carry their state from block to block.
"""

from __future__ import annotations

from math import ceil, gcd

import numpy as np

BLOCK = 1 << 15


class Energies:
    """Mean squares of frames of ``size`` samples every ``hop`` samples; two sums a hop are kept.

    Frames begin at multiples of the hop and end ``size % hop`` samples after one, so each hop is summed in two pieces.
    """

    def __init__(self, size: int, hop: int):
        self.size, self.hop, self.cut, self.n = size, hop, size % hop, 0
        self.tail, self.pieces = np.zeros(0), [np.zeros((0, 2))]

    def add(self, block: np.ndarray) -> None:
        """Take the next samples of one channel."""
        x = np.concatenate([self.tail, np.asarray(block, dtype=np.float64)])
        self.n += len(block)
        whole = len(x) // self.hop * self.hop
        squares = x[:whole].reshape(-1, self.hop) ** 2
        self.pieces.append(np.stack([squares[:, : self.cut].sum(axis=1), squares[:, self.cut :].sum(axis=1)], axis=1))
        self.tail = x[whole:]

    def mean_squares(self) -> np.ndarray:
        """One number for each whole frame."""
        frames = (self.n - self.size) // self.hop + 1 if self.n >= self.size else 0
        if not frames:
            return np.zeros(0)
        last = np.array([[(self.tail[: self.cut] ** 2).sum(), 0.0]])  # read only where the last frame ends within the tail
        pieces = np.concatenate([*self.pieces, last])
        hops = pieces.sum(axis=1)
        whole = self.size // self.hop
        total = sum(hops[k : k + frames] for k in range(whole))
        return (total + pieces[whole : whole + frames, 0] if self.cut else total) / self.size


def mean_squares(samples: np.ndarray, size: int, hop: int) -> np.ndarray:
    """Mean squares of the frames of one channel."""
    energies = Energies(size, hop)
    for at in range(0, len(samples), BLOCK):
        energies.add(samples[at : at + BLOCK])
    return energies.mean_squares()


class Biquad:
    """A second-order recursion.  Its two state variables are all that a block knows of those before it.

    A block is cut into short rows.  What a row's own samples give is one matrix product for all rows; how the states follow from row to row
    is a recursion of two numbers; what they add to a row is a second product.
    """

    ROW = 64

    def __init__(self, b: np.ndarray, a: np.ndarray):
        n = self.ROW
        step = np.array([[-a[1], 1.0], [-a[2], 0.0]])
        feed = np.array([b[1] - a[1] * b[0], b[2] - a[2] * b[0]])
        powers = [np.eye(2)]
        for _ in range(n):
            powers.append(powers[-1] @ step)
        impulse = np.array([b[0], *(float((powers[k] @ feed)[0]) for k in range(n - 1))])
        lag = np.arange(n)[:, None] - np.arange(n)
        self.own = np.where(lag >= 0, impulse[np.abs(lag)], 0.0).T
        self.ring = np.array([powers[k][0] for k in range(n)]).T
        self.into = np.array([powers[n - 1 - k] @ feed for k in range(n)])
        self.step, self.feed, self.b0, self.across = step, feed, b[0], powers[n]
        self.state = np.zeros(2)

    def __call__(self, block: np.ndarray) -> np.ndarray:
        """The next samples, filtered."""
        x = np.asarray(block, dtype=np.float64)
        rows = len(x) // self.ROW
        body = x[: rows * self.ROW].reshape(rows, self.ROW)
        (p, q), (r, s) = self.across.tolist()
        u, v = self.state.tolist()
        states = []
        for e, f in (body @ self.into).tolist():
            states.append((u, v))
            u, v = p * u + q * v + e, r * u + s * v + f
        out = body @ self.own + np.array(states).reshape(-1, 2) @ self.ring
        rest = []
        for value in x[rows * self.ROW :].tolist():
            rest.append(self.b0 * value + u)
            u, v = self.step[0, 0] * u + v + self.feed[0] * value, self.step[1, 0] * u + self.feed[1] * value
        self.state = np.array([u, v])
        return np.concatenate([out.reshape(-1), rest])


class Loudness:
    """Integrated loudness in LUFS: K-weighting, 0.4 s blocks with three quarters of overlap, absolute and relative gates; the power of channels is summed."""

    def __init__(self, rate: int, channels: int):
        # The filters of ITU-R BS.1770 as analogue parameters (gain in dB, quality, frequency in Hz).
        gain, q, f = 3.999843853973347, 0.7071752369554196, 1681.974450955533
        k, v = np.tan(np.pi * f / rate), 10 ** (gain / 20)
        vb, d = v**0.4996667741545416, 1 + k / q + k * k
        shelf = np.array([v + vb * k / q + k * k, 2 * (k * k - v), v - vb * k / q + k * k]) / d, np.array([d, 2 * (k * k - 1), 1 - k / q + k * k]) / d
        q, f = 0.5003270373238773, 38.13547087602444
        k = np.tan(np.pi * f / rate)
        d = 1 + k / q + k * k
        high = np.array([1.0, -2.0, 1.0]), np.array([d, 2 * (k * k - 1), 1 - k / q + k * k]) / d
        self.parts = [(Biquad(*shelf), Biquad(*high), Energies(int(0.4 * rate), int(0.1 * rate))) for _ in range(channels)]

    def add(self, block: np.ndarray) -> None:
        """Take the next samples (frames x channels)."""
        for c, (shelf, high, energies) in enumerate(self.parts):
            energies.add(high(shelf(block[:, c])))

    def value(self) -> float:
        """Loudness of all that came; minus infinity for silence."""
        power = sum(energies.mean_squares() for _, _, energies in self.parts)
        with np.errstate(divide="ignore"):
            level = -0.691 + 10 * np.log10(power)
        loud = power[level >= -70]
        if not len(loud):
            return float("-inf")
        gate = -0.691 + 10 * np.log10(loud.mean()) - 10
        return float(-0.691 + 10 * np.log10(power[(level >= -70) & (level >= gate)].mean()))


class Resampler:
    """Windowed-sinc resampling of one channel by a polyphase filter bank.

    For a ratio of rates reduced to ``up / down`` there are ``up`` places of an output between inputs, each with a row of taps; samples that
    later outputs need are carried over.
    """

    def __init__(self, rate: int, to: int, taps: int = 32):
        shared = gcd(rate, to)
        self.up, self.down, self.rate, self.to = to // shared, rate // shared, rate, to
        scale = min(1.0, to / rate)
        self.half = ceil(taps / scale)
        d = np.arange(self.up)[:, None] / self.up - np.arange(-self.half, self.half + 1)
        self.bank = scale * np.sinc(scale * d) * (0.5 + 0.5 * np.cos(np.pi * np.clip(d / (self.half + 1), -1, 1)))
        self.held, self.begin, self.n, self.made = np.zeros(self.half), -self.half, 0, 0

    def _upto(self, last: int) -> np.ndarray:
        """Outputs before ``last``, whose taps are all held."""
        out = np.zeros(max(0, last - self.made))
        for at in range(0, len(out), 4096):
            number = np.arange(self.made + at, min(self.made + at + 4096, last), dtype=np.int64)
            base, phase = np.divmod(number * self.down, self.up)
            views = np.lib.stride_tricks.sliding_window_view(self.held, 2 * self.half + 1)[base - self.half - self.begin]
            out[at : at + len(number)] = np.einsum("ij,ij->i", views, self.bank[phase])
        self.made += len(out)
        drop = min(self.made * self.down // self.up - self.half - self.begin, len(self.held))
        if drop > 0:
            self.held, self.begin = self.held[drop:], self.begin + drop
        return out

    def __call__(self, block: np.ndarray) -> np.ndarray:
        """Take samples and return the outputs that they complete."""
        self.held = np.concatenate([self.held, np.asarray(block, dtype=np.float64)])
        self.n += len(block)
        ready = self.n - self.half  # inputs around which all taps are known
        return self._upto(max(self.made, (ready * self.up + self.down - 1) // self.down) if ready > 0 else self.made)

    def end(self) -> np.ndarray:
        """The last outputs, with silence after the end."""
        self.held = np.concatenate([self.held, np.zeros(self.half + 2)])
        return self._upto(int(round(self.n * self.to / self.rate)))
