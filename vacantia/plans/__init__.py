"""vacantia.plans"""
