"""vacantia.operators"""
