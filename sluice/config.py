"""Connection settings for JDBC sources and sinks."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# Option keys whose values never appear in logs or reprs.
SECRET_KEYS = ("password", "pwd")


@dataclass(frozen=True)
class JdbcConfig:
    """A JDBC endpoint plus pass-through driver options.

    ``options`` carries anything the driver understands (connect / socket
    timeouts, SSL, keep-alive, ``useCursorFetch``...). Spark forwards unknown
    options to the driver as connection properties.
    """

    url: str
    driver: str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.url.startswith("jdbc:"):
            raise ValueError(f"not a JDBC URL: {redact_url(self.url)!r}")

    def spark_options(self) -> dict[str, str]:
        opts = {"url": self.url}
        if self.driver:
            opts["driver"] = self.driver
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        opts.update({k: str(v) for k, v in self.options.items()})
        return opts

    @property
    def flavor(self) -> str:
        return self.url.split(":", 2)[1].lower()

    def quote(self, name: str) -> str:
        """Quote one identifier the way the target database expects."""
        if self.flavor in ("mysql", "mariadb"):
            return "`" + name.replace("`", "``") + "`"
        return '"' + name.replace('"', '""') + '"'

    def qualified(self, table: str) -> str:
        """Quote a possibly ``schema.table`` name part by part."""
        return ".".join(self.quote(p) for p in table.split("."))

    def __repr__(self) -> str:  # never print the password
        shown = {k: ("******" if k.lower() in SECRET_KEYS else v) for k, v in self.options.items()}
        return f"JdbcConfig(url={redact_url(self.url)!r}, driver={self.driver!r}, user={self.user!r}, options={shown!r})"


def redact_url(url: str) -> str:
    """Hide the secrets of a JDBC URL: ``password=`` / ``pwd=`` values (in
    quotes or braces they may hold separators) and ``user:password@``."""
    secret = r"""(?i)((?:password|pwd)\s*=\s*)(\{[^}]*\}|"[^"]*"|'[^']*'|[^;&?#]*)"""
    hidden = re.sub(secret, r"\1******", url)
    return re.sub(r"(//[^/?#;:@]*):[^/?#]*@", r"\1:******@", hidden)


def derby_memory(name: str) -> JdbcConfig:
    """Embedded in-memory Derby: runs inside the Spark JVM, no server, no port.

    Used by tests and the registered round-trip queries; it is only reachable
    from executors that share the driver's JVM, i.e. local mode.
    """
    return JdbcConfig(
        url=f"jdbc:derby:memory:{name};create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )
