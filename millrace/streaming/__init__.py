"""Drivers that keep a queue moving: polling, notifications, heartbeats, waiting, buffering, handlers."""
