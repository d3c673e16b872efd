"""Writer options, checked on the driver before any task runs."""

from __future__ import annotations

PROTOCOLS = ("txt", "arrow")
WIRE = ("arrow_ipc", "arrow_framed")


def _port(options: dict[str, str], default: int) -> int:
    try:
        port = int(options.get("port", default))
    except ValueError:
        raise ValueError(f"port must be a number, not {options['port']!r}") from None
    if not 1 <= port <= 65535:
        raise ValueError(f"port must be 1 to 65535, not {port}")
    return port


def _one_of(options: dict[str, str], name: str, allowed: tuple[str, ...]) -> str:
    value = options.get(name, allowed[0])
    if value not in allowed:
        raise ValueError(f"unknown {name} {value!r}; one of {allowed}")
    return value


def file_options(options: dict[str, str]) -> dict:
    """protocol, data_format, base, file, tag, replicas of a file writer."""
    out = {"protocol": _one_of(options, "protocol", PROTOCOLS), "data_format": _one_of(options, "data_format", WIRE), "base": options.get("base", "."), "tag": options.get("tag", "")}
    if not options.get("file"):
        raise ValueError("'file' is required")
    return out | {"file": options["file"]}


def tcp_options(options: dict[str, str]) -> dict:
    if not options.get("addr"):
        raise ValueError("'addr' is required")
    return {
        "addr": options["addr"],
        "port": _port(options, 9000),
        "protocol": _one_of(options, "protocol", PROTOCOLS),
        "framing": _one_of(options, "framing", ("line", "len")),
        "data_format": _one_of(options, "data_format", WIRE),
        "tag": options.get("tag", ""),
        "tag_column": options.get("tag_column"),
        "attempts": int(options.get("attempts", 6)),
        "first_wait": float(options.get("first_wait", 1.0)),
    }


def syslog_options(options: dict[str, str]) -> dict:
    if not options.get("addr"):
        raise ValueError("'addr' is required")
    app = options.get("app_name")
    if app is not None and (not isinstance(app, str) or app.strip().isdigit()):
        raise ValueError(f"app_name must be text, not {app!r}")
    return {
        "addr": options["addr"],
        "port": _port(options, 514),
        "protocol": _one_of(options, "protocol", ("udp", "tcp")),
        "app_name": (app or "").strip() or options.get("name", "sparklog"),
        "attempts": int(options.get("attempts", 6)),
        "first_wait": float(options.get("first_wait", 1.0)),
    }
