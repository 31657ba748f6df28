"""Parameters of feature extraction and detection."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FeatureConfig:
    """Framing, spectrum and patch parameters; the defaults are the 22,050 Hz preset."""

    sample_rate: int = 22_050
    window: int = 551
    hop: int = 221
    bands: int = 64
    lower_hz: float = 125.0
    upper_hz: float = 7_500.0
    log_offset: float = 0.01
    patch_frames: int = 96
    value_type: str = "float"  # of patches and embeddings: float or double

    def __post_init__(self) -> None:
        if self.window < 1 or self.hop < 1 or self.patch_frames < 1 or self.bands < 1:
            raise ValueError("window, hop, patch_frames and bands must be positive")
        if not 0 <= self.lower_hz < self.upper_hz <= self.sample_rate / 2:
            raise ValueError(f"bands of {self.lower_hz}..{self.upper_hz} Hz do not lie within 0..{self.sample_rate / 2} Hz")

    @property
    def fft(self) -> int:
        """Transform length: the next power of two that holds one window."""
        return 1 << (self.window - 1).bit_length()

    @property
    def bins(self) -> int:
        return self.fft // 2 + 1

    @property
    def patch_samples(self) -> int:
        """Samples one patch reads: all its hops plus the tail of its last window."""
        return (self.patch_frames - 1) * self.hop + self.window

    @property
    def patch_hop(self) -> int:
        return self.patch_frames * self.hop


PRESET_22050 = FeatureConfig()
PRESET_16000 = FeatureConfig(sample_rate=16_000, window=400, hop=160)


@dataclass(frozen=True)
class DetectConfig:
    """Limits of the prediction list and the alert rule."""

    features: FeatureConfig = field(default_factory=FeatureConfig)
    max_predictions: int = 20
    min_score: float = 0.1
    max_frames: int = 300
    alert_patterns: tuple[str, ...] = ("Gun", "Explosion")


# Fixed values of the quantiser: clipping range and the 8-bit scale.
QUANTIZE_MIN = -2.0
QUANTIZE_MAX = 2.0
QUANTIZE_LEVELS = 255.0

# Fixed values of the mel scale (HTK): 1127 * ln(1 + f / 700).
MEL_Q = 1127.0
MEL_BREAK_HZ = 700.0

# Fixed length of a published clip: 10 s at 22,050 Hz.
CLIP_FRAMES = 220_500

# Fixed values of the live capture: sample rate and the seconds a buffer holds.
CAPTURE_RATE = 16_000
CAPTURE_MIN_SECONDS = 5
CAPTURE_MAX_SECONDS = 7

# int16 full scale.
FULL_SCALE = 32_768.0

# Fixed label sets of the training selection.
POSITIVE_CLASSES = ("Gunshot", "Gunfire", "Machine Gun", "Cap Gun")
NEGATIVE_CLASSES = (
    "Car",
    "Vehicle horn, car horn, honking",
    "Car alarm",
    "Air horn, truck horn",
    "Reversing beeps",
    "Police car (siren)",
    "Ambulance (siren)",
    "Fire engine, fire truck (siren)",
    "Motorcycle",
    "Traffic noise, roadway noise",
    "Speech",
)
