"""Job configuration from ``--key value`` arguments (CFG1, CFG2, CFG4)."""

from __future__ import annotations

from dataclasses import dataclass, field

REQUIRED = ("topic", "broker", "target-topic", "tables.path")
DEFAULTS = {
    "restart.attempts": "3",
    "restart.delay": "10",          # minutes
    "maxOutOfOrderness": "0",       # seconds
    "parseBody": "true",
    "az": "az1",
    "region": "boston",
    "checkpoint.interval": "100000",  # ms, the micro-batch trigger
}


def parse_args(argv: list[str]) -> dict[str, str]:
    """``--a 1 --b --c x`` -> ``{"a": "1", "b": "", "c": "x"}``."""
    out: dict[str, str] = {}
    i = 0
    while i < len(argv):
        tok = argv[i]
        if not tok.startswith("-"):
            raise ValueError(f"expected --key, got {tok!r}")
        key = tok.lstrip("-")
        if i + 1 < len(argv) and not argv[i + 1].startswith("--"):
            out[key] = argv[i + 1]
            i += 2
        else:
            out[key] = ""
            i += 1
    return out


def get_value(args: dict[str, str], key: str, default: str) -> str:
    """Optional argument: the default when the key is absent **or empty** (CFG2)."""
    v = args.get(key)
    return default if v is None or v == "" else v


@dataclass(frozen=True)
class PipelineConfig:
    topic: str
    broker: str
    target_topic: str
    tables_path: str
    restart_attempts: int = 3
    restart_delay_min: int = 10
    max_out_of_order_s: int = 0
    parse_body: bool = True
    az: str = "az1"
    region: str = "boston"
    trigger_ms: int = 100000
    extra: dict = field(default_factory=dict)

    @classmethod
    def from_args(cls, argv: list[str]) -> "PipelineConfig":
        args = parse_args(argv)
        missing = [k for k in REQUIRED if not args.get(k)]
        if missing:
            raise ValueError(f"missing required arguments: {', '.join(missing)}")
        g = lambda k: get_value(args, k, DEFAULTS[k])
        return cls(
            topic=args["topic"], broker=args["broker"], target_topic=args["target-topic"],
            tables_path=args["tables.path"],
            restart_attempts=int(g("restart.attempts")), restart_delay_min=int(g("restart.delay")),
            max_out_of_order_s=int(g("maxOutOfOrderness")), parse_body=g("parseBody").lower() == "true",
            az=g("az"), region=g("region"), trigger_ms=int(g("checkpoint.interval")),
            extra={k: v for k, v in args.items() if k not in REQUIRED and k not in DEFAULTS},
        )

    def job_name(self) -> str:
        """Application name listing every setting, extra properties included (CFG4)."""
        fixed = {"topic": self.topic, "broker": self.broker, "target-topic": self.target_topic,
                 "tables.path": self.tables_path, "parseBody": str(self.parse_body).lower(),
                 "maxOutOfOrderness": str(self.max_out_of_order_s), "restart.attempts": str(self.restart_attempts),
                 "restart.delay": str(self.restart_delay_min), "az": self.az, "region": self.region,
                 "checkpoint.interval": str(self.trigger_ms)}
        return "logweave - " + "; ".join(f"{k}: {v}" for k, v in {**fixed, **self.extra}.items())
