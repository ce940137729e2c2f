"""vacantia.streaming"""
