"""vacantia.sources"""
