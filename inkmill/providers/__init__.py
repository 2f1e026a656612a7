"""Chat-completion services behind one small interface."""

from inkmill.providers.base import ChatProvider, ChatResult, ProviderError, build, register

__all__ = ["ChatProvider", "ChatResult", "ProviderError", "build", "register"]
